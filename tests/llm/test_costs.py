"""Work that is saved without another result: words and pairs of op10, dictionaries of op7, workers and sets of op2."""

import random
import re

import numpy as np
import pyarrow as pa
from sievemark.llm import language_zstd, ngram_join, shingles, toxicity_kernel
from sievemark.llm.toxicity_kernel import NOTHING, ToxicModel


def machine(seed: int) -> ToxicModel:
    r = np.random.default_rng(seed)
    weights = r.normal(size=toxicity_kernel.ALPHABET**3).astype(np.float32)
    weights[r.random(len(weights)) < 0.9] = 0
    return ToxicModel(weights, -0.3, (0.0, 1.0, 1.0, 1.0))


def texts(n: int) -> list[str | None]:
    r = random.Random(7)
    words = ["".join(r.choice("abcdefgh-é日0.!") for _ in range(r.choice((1, 1, 2, 5, 9, 13, 30, 60)))) for _ in range(300)]
    return [None, "", " ", "!?", "one", "a b c", "i. d. i. o. t"] + [" ".join(r.choices(words, k=r.randrange(40))) for _ in range(n)]


def plainly(model: ToxicModel, text: str | None) -> tuple[float, float, float]:
    words, tokens = toxicity_kernel.split_words(text)
    best = sorted(model.words(sorted(words)).tolist(), reverse=True) + [NOTHING] * 2
    pairs = model.pairs.words(list(map(str.__add__, tokens, tokens[1:]))).tolist() if len(tokens) > 1 else []
    return max(best[0], NOTHING), max(best[1], NOTHING), max([*pairs, NOTHING])


def test_toxic_values_of_words_met_before(monkeypatch):
    model = machine(1)
    model.pairs = machine(2)
    rows = texts(60)
    expected = np.array([plainly(model, t) for t in rows])
    asked = []
    own = toxicity_kernel.Sides.add
    monkeypatch.setattr(toxicity_kernel.Sides, "add", lambda self, words: (asked.extend(words), own(self, words))[1])
    values = toxicity_kernel.word_values(model)
    for _ in range(2):
        got = [v for start in range(0, len(rows), 5) for v in values(rows[start : start + 5])]
        assert np.abs(np.array(got) - expected).max() < 1e-4
    assert asked and len(asked) == len(set(asked))  # each word is worked out once for all batches
    monkeypatch.setattr(toxicity_kernel, "MAX_SIDES", 10)  # forgets all again and again
    values = toxicity_kernel.word_values(model)
    got = [v for start in range(0, len(rows), 5) for v in values(rows[start : start + 5])]
    assert np.abs(np.array(got) - expected).max() < 1e-4


def test_only_pairs_that_may_be_the_highest_are_valued(monkeypatch):
    model = machine(3)
    valued = []
    own = toxicity_kernel.Sides.values
    monkeypatch.setattr(toxicity_kernel.Sides, "values", lambda self, a, b: (valued.extend(zip(a, b)), own(self, a, b))[1])
    r = random.Random(4)
    rows = [["".join(r.choices("abcdefghijkl", k=7)) for _ in range(200)] for _ in range(5)]
    best = [max(model.words(list(map(str.__add__, t, t[1:]))).tolist()) for t in rows]
    assert np.abs(np.array(toxicity_kernel._best_pairs(model, rows)) - best).max() < 1e-4
    assert len(valued) == len(set(valued)) < 5 * 199 * 3 / 4


def test_languages_are_sized_one_dictionary_after_the_other(monkeypatch):
    r = random.Random(5)
    data = {n: " ".join("".join(r.choices(letters, k=5)) for _ in range(400)) for n, letters in (("x", "abcde"), ("y", "efghi"), ("z", "ijklm"))}
    model = language_zstd.ZstdLanguages({n: language_zstd.plain(t) for n, t in data.items()})
    rows = [None, "", "12 !", *[" ".join("".join(r.choices("abcdefghijklm", k=5)) for _ in range(n)) for n in (1, 3, 50, 900)]]
    plain = [model.predict(t) for t in rows]
    order = []
    model.sizers = [lambda b, f=f, k=k: (order.append(k), f(b))[1] for k, f in enumerate(model.sizers)]
    assert model.predict_all(rows) == plain and model.predict_all([]) == []
    assert order == sorted(order) and len(set(order)) == 3
    for t, found in zip(rows[3:], plain[3:]):
        body = language_zstd.plain(t)
        blocks = [body[i : i + language_zstd.BLOCK] for i in range(0, len(body), language_zstd.BLOCK)]
        sizes = sorted(sum(len(f(b)) for b in blocks) for f in model.sizers)
        assert found[2] == (sizes[1] - sizes[0]) / sizes[1]


def test_no_task_of_the_ngram_join_has_two_python_workers(spark, monkeypatch):
    plans = []
    own = ngram_join.cut_lineage
    monkeypatch.setattr(ngram_join, "cut_lineage", lambda df: (plans.append(df._jdf.queryExecution().executedPlan().toString()), own(df))[1])
    monkeypatch.setattr(ngram_join, "TEAM", 2)
    r = random.Random(6)
    base = [str(r.randrange(10**6)) for _ in range(60)]
    rows = [(i, " ".join([*base[:-1], str(i)])) for i in range(8)] + [(20, "quite another text of its own"), (21, None)]
    got = ngram_join.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {x.doc_id: x.component_id for x in got} == {**{i: 0 for i in range(8)}, 20: 20, 21: 21}
    assert any("lset" in p for p in plans)
    for plan in plans:
        above: list[tuple[int, str]] = []
        for line in plan.splitlines():
            m = re.search(r"[A-Za-z]\w*", line.replace("*(", "  "))
            if not m:
                continue
            while above and above[-1][0] >= m.start():
                above.pop()
            stage = [name for _, name in above]
            last = max((i for i, name in enumerate(stage) if name.endswith("Exchange")), default=-1)
            assert m.group() != "MapInArrow" or "MapInArrow" not in stage[last + 1 :], plan
            above.append((m.start(), m.group()))


def test_shingle_sets_of_many_texts_at_once():
    r = random.Random(8)
    word = lambda: "".join(r.choice("abCDé日0\0. ") for _ in range(r.choice((1, 2, 5, 7, 8, 9, 16, 17, 63, 64, 65, 130))))
    words = [word() for _ in range(60)]
    rows = [None, "", " \t\n\v\f\r ", "one", "One TWO", "one two\x1cthree", "a b c d", "a b c d e", "a b c d e a b c d e a b c d e"]
    rows += ["".join(w + r.choice((" ", "\n", "\t ", "\v\f\r")) for w in r.choices(words, k=r.randrange(30)))[r.randrange(2) :] for _ in range(300)]
    rows += ["x", "y", None]
    for texts in (pa.array(rows), pa.array(rows, pa.large_string()), pa.array(rows).slice(5, 100), pa.array(rows[:1], pa.string()), pa.array([], pa.string())):
        h, at = shingles.contract_words(texts)
        s, starts = shingles.shingle_sets(h, at)
        assert len(at) == len(starts) == len(texts) + 1 and at[-1] == len(h) and starts[-1] == len(s)
        names: dict = {}
        for k, text in enumerate(texts.to_pylist()):
            plain = re.findall(rb"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or "").encode())
            n = min(5, len(plain))
            runs = [tuple(plain[i : i + n]) for i in range(len(plain) - n + 1)] if n else []
            found = s[starts[k] : starts[k + 1]]
            assert at[k + 1] - at[k] == len(plain) and len(found) == len(set(runs)) and (found[1:] > found[:-1]).all()
            for w, x in [*zip(plain, h[at[k] : at[k + 1]].tolist()), (frozenset(runs), found.tobytes())]:
                assert names.setdefault(w, x) == x and names.setdefault((x,), w) == w  # one hash per word, one set per set


def test_points_and_routes_of_many_sets_at_once(spark):
    r = np.random.default_rng(9)
    sets = [np.unique(r.integers(0, 2**64, n, dtype=np.uint64)) for n in (0, 3, 0, 900, 1, 0)]
    at = np.cumsum([0] + [len(s) for s in sets])
    flat = np.concatenate(sets)
    assert (ngram_join.count_vectors(flat, at, 64) == [ngram_join.count_vector(s, 64) for s in sets]).all()
    data, starts = ngram_join.numbers(ngram_join.binaries(flat, at).slice(1, 4), np.uint64)
    assert (data == flat[at[1] : at[5]]).all() and (starts == at[1:6] - at[1]).all()
    rows = [(i, " ".join(str(x) for x in r.integers(0, 40, n))) for i, n in enumerate((0, 1, 3, 5, 6, 9, 10, 11, 40, 300))]
    texts = spark.createDataFrame(rows, "id long, text string")
    plain = {i: shingles.shingle_sets(*shingles.contract_words(pa.array([t])))[0].view(np.int64).tolist() for i, t in rows}
    often = [x for s in plain.values() for x in s[::3]]
    for late in (often, []):
        for x in ngram_join._routes(texts, "id", "text", late).collect():
            s = sorted(plain[x.id], key=lambda v: (v in set(late), v % 2**64))
            assert x.n == len(s) and sorted(x.routes) == sorted(s[: len(s) - -(-80 * len(s) // 100) + 1] if s else [])
            assert (np.frombuffer(x.vec, np.uint16) == ngram_join.count_vector(np.array(s, np.int64).view(np.uint64))).all()


def test_long_texts_that_share_a_passage_are_no_candidates(spark):
    r = random.Random(10)
    words = lambda n: [str(r.randrange(10**8)) for _ in range(n)]
    passages = [words(40) for _ in range(13)]
    own = [words(3000) for _ in range(12)]
    rows = [(i, " ".join([*w, *passages[i], *passages[i + 1]])) for i, w in enumerate(own)]
    rows.append((50, " ".join([*own[4][:2900], *words(60), *passages[4], *passages[5]])))
    texts = spark.createDataFrame(rows, "id long, text string")
    found = ngram_join._candidate_forest(ngram_join._routes(texts, "id", "text", [])).collect()
    assert [tuple(x) for x in found] == [(4, 50)]
