"""Byte-pair encoding, chat formatting, HTML extraction, winnowing, decontamination and the n-gram join against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievemark.llm import bpe_transducer, chat_prefix, components, decontamination, html_consensus, ngram_join, queries, shingles, winnowing

SMALL = "/root/testdata/sf0.001"
MIDDLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()]


def odd_docs(spark):
    rows = [(5, None, 1), (6, "", 2), (7, "one", 3), (7, "one", 3), (8, "w " * 3000, None), (9, "a b c d", 4), (None, "null id", 5)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids int")


# --- byte-pair encoding ---------------------------------------------------------------------------------


def test_transducer_equals_the_library(docs):
    import public_tokenizers
    import tiktoken

    t = bpe_transducer.transducer()
    e = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=t.ranks, special_tokens={})
    r = random.Random(4)
    letters = " \n\t  \x1c\x85\xa0​　abcdefgh'stllREve0123٣²ⅷ.,!?-_日本語é😀\x00́ſK"
    texts = [x for _, x in docs] + ["".join(r.choice(letters) for _ in range(r.randint(0, 40))) for _ in range(3000)]
    texts += ["a" * 5000, " " * 300 + "x", "<|endoftext|>", "\n\n x  y\t"]
    for x in texts:
        ids = t.encode(x)
        assert ids == e.encode_ordinary(x)
        assert "".join(bpe_transducer.decode_stream(t.bytes_of, ([i] for i in ids))) == x


def test_small_memory_gives_the_same_ids(docs):
    t = bpe_transducer.transducer()
    import public_tokenizers

    small = bpe_transducer.BpeTransducer(t.ranks, public_tokenizers.PATTERN, max_states=50, max_chunks=20)
    for _, x in docs[:20]:
        assert small.encode(x) == t.encode(x)


def test_utf8_machine_with_every_cut():
    text = "aé日😀\x00ß"
    data = text.encode() + b"\xff\xe2\x82" + b"z"
    for i in range(len(data) + 1):
        for j in range(i, len(data) + 1):
            m = bpe_transducer.Utf8Machine()
            assert m.feed(data[:i]) + m.feed(data[i:j]) + m.feed(data[j:]) + m.end() == data.decode("utf-8", "replace")


def test_encode_and_decode_rows(spark):
    df = odd_docs(spark)
    back = bpe_transducer.bpe_decode(bpe_transducer.bpe_encode(df)).collect()
    assert len(back) == 7 and all(r.decoded == (r.text or "") and r.n_tokens == len(r.ids) for r in back)
    assert bpe_transducer.bpe_encode(df.limit(0)).count() == 0
    empty = bpe_transducer.bpe_digests(df).filter("text is null").first()
    nothing = hashlib.sha256(b"").hexdigest()
    assert (empty.n_tokens, empty.ids_sha256, empty.decoded_sha256) == (0, nothing, nothing)


# --- chat formatting ------------------------------------------------------------------------------------


def digests(rows):
    talks = defaultdict(list)
    for conv, turn, role, text in rows:
        talks[conv].append((turn is not None, turn, role or "", text or ""))
    out = {}
    for conv, turns in talks.items():
        turns.sort(key=lambda t: (t[0], t[1] or 0, t[2], t[3]))
        said = "".join(f"{r}\n{x}\n" for _, _, r, x in turns)
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_chat_reads_back(spark):
    bits = ["</s>", "[INST]", "[/INST]", "<|", "|>", "\\", "<", "[", "<<SYS>>", "<</SYS>>", "a", "\n", "<s>", "é😀", "|\\>", "</s>\n", "$1"]
    r = random.Random(7)
    rows = [(c, t, r.choice(["user", "assistant", "system", "a|>b", "x\n<|y", None]), "".join(r.choice(bits) for _ in range(9))) for c in range(60) for t in range(r.randint(1, 7))]
    rows += [(None, 0, "user", None), (70, None, None, None), (70, 1, "assistant", ""), (71, 0, "user", "u"), (71, 0, "user", "u")]
    df = spark.createDataFrame([(*x, 1) for x in rows], "conv_id long, turn long, role string, text string, example int")
    got = {x.conv_id: (x.n_turns, x.turns_sha256, x.loss_chars, x.loss_sha256) for x in chat_prefix.conversation_digests(chat_prefix.prefix_examples(df)).collect()}
    assert got == digests(rows)


def test_each_reply_is_an_example_with_all_before(spark):
    rows = [(1, 0, "user", "q1"), (1, 1, "assistant", "r1"), (1, 2, "user", "q2"), (1, 3, "assistant", "r2 <|"), (1, 4, "user", "q3")]
    out = chat_prefix.prefix_examples(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).orderBy("example").collect()
    assert [x.text[x.loss_start : x.loss_end] for x in out] == ["r1", "r2 <\\|", ""]
    assert out[1].text.startswith(out[0].text) and out[2].text.startswith(out[1].text) and [x.last for x in out] == [False, False, True]


def test_chat_query_is_native_and_has_the_extra_conversation(spark):
    df = queries.QUERIES["op5_chat_prefix"](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, i, role, "</s>[INST] ok [/INST]") for i, role in enumerate(("user", "assistant"))]
    got = {x.conv_id: (x.n_turns, x.turns_sha256, x.loss_chars, x.loss_sha256) for x in df.collect()}
    assert got == digests(rows)


# --- HTML -----------------------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="</p>";</script><style>p{}</style></head><body>
<header class="site"><h2>Site</h2></header><nav><ul><li><a href="/x">menu</a></ul></nav><div class="cookie-notice">We use cookies</div>
<div class="post-%d"><h1>Head &amp; line</h1><p>First <b>bold</b>&nbsp;text.<p>Second<br>line
<div class="ad">Buy now</div><form><input><p>Sign up</form><ul><li>one<li>two</ul><aside>side</aside>
<div class="comments"><p>First!</p></div></div><footer>&copy; foot</footer>"""


def test_html_leaves_out_what_is_not_the_article():
    text = "Head & line First bold text. Second line one two"
    path = html_consensus.best_path(PAGE % 7)[0]
    assert path == "/div.post-N" and html_consensus.extract(PAGE % 7, path) == text
    assert html_consensus.extract(PAGE % 8, "/div.gone") == text  # falls back to the page's own best container


def test_html_odd_rows_and_votes(spark):
    rows = [(i, "http://h.example/a", PAGE % i, i) for i in range(4)]
    rows += [(10, None, None, 0), (11, "http://h.example/b", "", 0), (12, "::bad[", "plain &lt;text", 0), (13, "http://h.example/a", "<p>x</p><!-- cut", 0), (13, "http://h.example/a", "<div><p", 0)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    out = html_consensus.extract_main_text(df).collect()
    texts = defaultdict(list)
    for r in out:
        texts[r.page_id].append(r.text)
        assert r.n_chars == len(r.text)
    assert len(out) == len(rows) and len({t for i in range(4) for t in texts[i]}) == 1
    assert texts[10] == [""] and texts[11] == [""] and texts[12] == ["plain <text"] and sorted(texts[13]) == ["", "x"]
    assert html_consensus.extract_main_text(df.limit(0)).count() == 0


def test_html_keeps_the_whole_article_around_the_best_container(spark):
    body = "<p>" + "many words of the body " * 20
    nested = f"<nav>n</nav><article class=a><h1>Head</h1><div class=body>{body}</div></article><footer>f</footer>"
    two = f"<main><h1>Head</h1><section class=x>{body}</section><div class=ad>Buy</div><section class=y><p>Short end</section></main>"
    plain = f"<div class='w-1/2'><h1>Head</h1><div class='w-1/3'>{body}</div><div class=end>Last</div><div class=more><a href=/1>one</a> <a href=/2>two</a></div></div>"
    rows = [(10 * k + i, f"http://h{k}.example/{i}", html) for k, html in enumerate((nested, two, plain)) for i in range(3)]
    out = html_consensus.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    words = " ".join(body[3:].split())
    wanted = [f"Head {words}", f"Head {words} Short end", f"Head {words} Last"]
    assert len(out) == len(rows) and all(r.text == wanted[r.page_id // 10] for r in out)


def test_html_salted_join_gives_the_same(spark, monkeypatch):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    few = {r.page_id: r.text for r in html_consensus.extract_main_text(pages).collect()}
    monkeypatch.setattr(html_consensus, "MAX_BROADCAST_HOSTS", 0)
    assert {r.page_id: r.text for r in html_consensus.extract_main_text(pages).collect()} == few


# --- winnowing ------------------------------------------------------------------------------------------


def winnow(grams, w=winnowing.WINDOW):
    """All windows, one after the other."""
    if not grams:
        return []
    chosen = set()
    for s in range(max(len(grams) - w, 0) + 1):
        part = grams[s : s + w]
        chosen.add(s + max(i for i, h in enumerate(part) if h == min(part)))
    return sorted((i, grams[i]) for i in chosen)


def test_winnowing_equals_all_windows(spark):
    r = random.Random(8)
    rows = [(i, " ".join(r.choice("abcd") for _ in range(r.randint(0, 40)))) for i in range(120)] + [(200, None), (201, "  x \n")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    words = F.filter(F.split(F.lower(F.coalesce("text", F.lit(""))), r"\s+"), lambda w: w != "")
    grams = df.select("doc_id", words.alias("w")).select("doc_id", "w", F.transform("w", lambda x: F.xxhash64(x)).alias("h"))
    grams = {x.doc_id: x.g for x in grams.select("doc_id", winnowing._gram_hashes(F.col("w"), F.col("h")).alias("g")).collect()}
    for x in winnowing.with_fingerprint(df, "text", "fp").collect():
        n = len((x.text or "").split())
        assert len(grams[x.doc_id]) == (max(n - winnowing.GRAM + 1, 1) if n else 0)
        assert [tuple(p) for p in x.fp] == winnow(grams[x.doc_id])


def test_winnowing_query(spark, docs, monkeypatch):
    monkeypatch.setattr(winnowing, "ROWS_PER_BUCKET", 7)
    monkeypatch.setitem(winnowing.with_next.__kwdefaults__ or {}, "rows", 7)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {x.doc_id: x for x in winnowing.edited_fingerprints(df).collect()}
    assert len(got) == len(docs)
    for (i, t), (_, after) in zip(docs, docs[1:] + docs[:1]):
        h = len(t) // 2
        assert got[i].edited_sha256 == hashlib.sha256((t[: len(t) - h] + after[:h]).encode()).hexdigest()
        assert got[i].n_chars == len(t) and 0 <= got[i].near_edited <= 1
    same = defaultdict(set)
    for i, t in docs:
        same[t].add(got[i].fingerprint)
    assert all(len(s) == 1 for s in same.values())
    assert np.mean([x.near_edited for x in got.values()]) > 0.4 > 0.1 > np.mean([x.near_next for x in got.values()])


def test_next_row_in_any_number_of_buckets(spark):
    rows = [(i * i, f"t{i}", i) for i in range(50)] + [(None, "n", 0), (9, "t3", 3), (16, None, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _next int")
    order = sorted(((i if i is not None else -(2**63), t or "") for i, t, _ in rows))
    want = sorted((a[1], b[1]) for a, b in zip(order, order[1:] + order[:1]))
    for size in (3, 10, 1000):
        filled = df.withColumn("text", F.coalesce("text", F.lit("")))
        got = sorted((r.text, r._next.text) for r in winnowing.with_next(filled, "doc_id", ["text"], rows=size).collect())
        assert got == want
    assert winnowing.edited_fingerprints(df).count() == len(rows) and winnowing.edited_fingerprints(df.limit(0)).count() == 0
    plan = winnowing.edited_fingerprints(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- decontamination ------------------------------------------------------------------------------------


def windows_alike(item, text):
    """Best weighted similarity over all windows of the item's length."""
    h = shingles.WordHashes()
    a, b = h(shingles.plain_words(item)), h(shingles.plain_words(text))
    mine, best = Counter(shingles.grams(a, 5).tolist()), 0.0
    for s in range(max(len(b) - len(a), 0) + 1 if len(a) and len(b) else 0):
        other = Counter(shingles.grams(b[s : s + len(a)], 5).tolist())
        best = max(best, sum((mine & other).values()) / sum((mine | other).values()))
    return best


def test_leaks_equal_all_windows(spark, docs):
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    planted = [(10_000 + k, f"some words before {t.upper()} !! and after") for k, t in items[:10]]
    texts = docs[:60] + planted
    got = {(r.doc_id, r.item_id) for r in decontamination.find_leaks(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = {(d, i) for d, t in texts for i, x in items if windows_alike(x, t) >= 0.8}
    assert got == want and {(10_000 + k, k) for k, _ in items[:10]} <= got


def test_all_prints_within_the_radius_are_found():
    r = np.random.default_rng(1)
    prints = r.integers(0, 2**63, 40, dtype=np.uint64)
    noisy = []
    for p in prints:
        for bits in range(0, 16):
            flip = sum(1 << int(b) for b in r.choice(64, bits, replace=False))
            noisy.append(int(p) ^ flip)
    noisy = np.array(noisy, dtype=np.uint64)
    c = decontamination.SizeClass(8, prints, np.arange(40), np.zeros(40, int))
    near = np.bitwise_count(noisy[:, None] ^ prints[None]) <= decontamination.RADIUS
    assert set(c.near(noisy, np.ones(len(noisy), bool))) == set(zip(*[x.tolist() for x in np.nonzero(near)]))


def test_window_prints_equal_bit_counts():
    h = np.random.default_rng(2).integers(0, 2**63, 60, dtype=np.uint64)
    for n in (1, 7, 31):
        got = decontamination.fingerprints(decontamination.running_sums(h), n)
        for i, p in enumerate(got.tolist()):
            ones = [sum(int(x) >> b & 1 for x in h[i : i + n]) for b in range(64)]
            assert p == sum(1 << b for b in range(64) if 2 * ones[b] > n)


def test_leaks_of_odd_rows(spark):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "one"), (4, "a b c d"), (5, "w " * 300)], "item_id long, text string")
    got = sorted((r.doc_id, r.item_id) for r in decontamination.find_leaks(odd_docs(spark), bench).collect())
    assert got == [(7, 3), (7, 3), (8, 5), (9, 4)]
    assert decontamination.find_leaks(odd_docs(spark), bench, most=2).count() == 4
    assert decontamination.find_leaks(odd_docs(spark).limit(0), bench).count() == 0
    assert decontamination.find_leaks(odd_docs(spark), bench.limit(0)).count() == 0
    assert decontamination.drop_leaks(odd_docs(spark), bench).count() == 3


# --- n-gram join ----------------------------------------------------------------------------------------


def joined(rows):
    """Set sizes and components by comparing all pairs."""
    sets = []
    for _, t in rows:
        w = [x for x in "".join(c.lower() if c.isascii() else c for c in t or "").encode().split()]
        n = min(5, len(w))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set())
    up = {i: i for i, _ in rows}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for x in range(len(rows)):
        for y in range(x):
            both = len(sets[x] & sets[y])
            if both and 100 * both >= 80 * len(sets[x] | sets[y]):
                a, b = root(rows[x][0]), root(rows[y][0])
                up[max(a, b)] = min(a, b)
    return sorted((i, len(s), root(i)) for (i, _), s in zip(rows, sets))


def near_copies(seed=3):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(4))
    passage = [word() for _ in range(30)]
    rows = []
    for _ in range(12):
        base = [word() for _ in range(r.choice((20, 60, 120)))] + (passage if r.random() < 0.7 else [])
        for _ in range(r.randint(1, 9)):
            text = list(base)
            for _ in range(r.randint(0, 4)):
                text[r.randrange(len(text))] = word()
            rows.append(" ".join(text[: len(text) - r.randint(0, 6)]))
    rows += ["", None, "one two", "One TWO", "a b c d e", "a b c d e", "É b c d e"]
    r.shuffle(rows)
    return list(enumerate(rows, 1))


@pytest.mark.parametrize("team,block,cell", [(512, 256, 2048), (3, 2, 4)])
def test_join_equals_all_pairs(spark, monkeypatch, team, block, cell):
    monkeypatch.setattr(ngram_join, "TEAM", team)
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "FINE_BLOCK", block)
    monkeypatch.setattr(ngram_join, "CELL", cell)
    rows = near_copies()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("id", F.lit(1))
    assert sorted(tuple(r) for r in ngram_join.similar_documents(df).collect()) == joined(rows)


def test_join_of_long_texts_equals_all_pairs(spark):
    r = random.Random(12)
    word = lambda: str(r.randrange(10**6))
    passage, rows = [word() for _ in range(150)], []
    for copies in (1, 2, 3, 4, 14):
        base = [word() for _ in range(r.choice((600, 900, 1400)))] + passage
        for _ in range(copies):
            text = list(base)
            for _ in range(len(text) // 100 + r.randrange(len(text) // 80)):  # pairs of about the similarity that is needed
                text[r.randrange(len(text))] = word()
            rows.append(" ".join(text))
    r.shuffle(rows)
    rows = list(enumerate(rows, 1))
    want = joined(rows)
    assert len(rows) > len({x[2] for x in want}) > 5
    assert sorted(tuple(x) for x in ngram_join.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()) == want


def test_join_of_repeated_and_odd_rows(spark):
    rows = [(3, "a b c d e f"), (3, "a b c d e f"), (5, "A b c d e f"), (None, "a b c d e f"), (7, None)]
    got = ngram_join.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((tuple(r) for r in got), key=repr) == sorted([(3, 2, 3), (3, 2, 3), (5, 2, 3), (None, 2, None), (7, 0, 7)], key=repr)
    assert ngram_join.similar_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_tree_gives_all_pairs_within_the_bound():
    r = np.random.default_rng(5)
    base = r.integers(0, 9, (40, ngram_join.GROUPS))
    points = np.maximum(np.concatenate([base + r.integers(-1, 2, base.shape) * (r.random(base.shape) < 0.1) for _ in range(12)]), 0).astype(np.uint16)
    sizes = points.sum(1).astype(int)
    found = set()
    for i, j in ngram_join.CountRTree(points, sizes).pairs():
        found.update(tuple(sorted(p)) for p in zip(i.tolist(), j.tolist()))
    near = ngram_join.bounds(points[:, None], points[None]) >= ngram_join.need(sizes[:, None], sizes[None])
    want = {(i, j) for i, j in zip(*[x.tolist() for x in np.nonzero(near)]) if i < j and 100 * min(sizes[i], sizes[j]) >= 80 * max(sizes[i], sizes[j])}
    assert want <= found


def test_components_of_a_long_chain(spark):
    rows = [(i, i + 1) for i in range(1, 80)] + [(200, 100), (100, 150), (9, 9)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(rows, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 81)}, 200: 100, 100: 100, 150: 100}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
