"""Periodic runs, SimHash balls and the Merkle manifest against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sievemark.llm import merkle_veb, periodic_runs, queries, simhash_ball

SMALL = "/root/testdata/sf0.001"


def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows and ids, and columns whose names clash with inner ones."""
    rows = [
        (5, None, None, None, None),
        (6, "", "en", "web", 0),
        (7, "one", "en", None, 3),
        (7, "one", "en", None, 3),
        (7, "two", "en", "web", 3),
        (8, "w " * 30000, "fr", "web", 60000),
        (9, "A b c\x1cd é", None, "web", 9),
        (None, "null id", "de", "web", 7),
        (None, None, "de", None, None),
        (10, "x y z " * 9, "zz", "web", None),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    return spark.createDataFrame(rows, schema).withColumns({c: F.lit(1) for c in ("_tree", "_leaf", "_id", "runs", "fingerprint", "_in0")})


def empty_docs(spark):
    return odd_docs(spark).limit(0)


def given(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x if x is not None else 0) for x in r))


# --- periodic runs --------------------------------------------------------------------------------------


def brute_runs(words, least, exponent):
    n, out = len(words), {}
    for q in range(1, n // exponent + 1):
        i = q
        while i < n:
            first = i
            while i < n and words[i] == words[i - q]:
                i += 1
            if i - first + q >= max(least, exponent * q) and i > first:
                out.setdefault((first - q, i), q)
            i += i == first
    return sorted((a, e - a, q) for (a, e), q in out.items())


def random_words(r):
    n, out = r.randint(0, 90), []
    if r.random() < 0.5:
        out = [r.choice(b"ab") for _ in range(n)]
    while len(out) < n:
        base = [r.choice(b"abcd") for _ in range(r.randint(1, 9))] * r.randint(1, 6)
        out += (base * r.randint(1, 5))[: r.randint(1, 60)]
    return [bytes([x]) for x in out]


@pytest.mark.parametrize("least, exponent", [(6, 4), (2, 2), (1, 3)])
def test_runs_equal_brute_force_for_every_portion(least, exponent):
    r = random.Random(exponent)
    for _ in range(60):
        words = random_words(r)
        for portion in (1, 5, 1 << 16):
            assert periodic_runs.find_runs(words, least, exponent, portion) == brute_runs(words, least, exponent)


def test_wrong_hashes_do_no_harm(monkeypatch):
    # Stretches with the same words in any order now collide; single words never do.
    monkeypatch.setattr(periodic_runs, "_powers", lambda base, first, count: np.ones(count, "uint64"))
    r = random.Random(9)
    for _ in range(40):
        words = random_words(r)
        assert periodic_runs.find_runs(words) == brute_runs(words, 6, 4)


def test_long_periodic_texts_stay_cheap():
    n = 200_000
    assert periodic_runs.find_runs([b"a"] * n) == [(0, n, 1)]
    words = [b"%d" % (i % 700) for i in range(n)]
    assert periodic_runs.find_runs(words) == [(0, n, 700)]
    assert periodic_runs.collapse(words, [(0, n, 700)]) == words[:700]


def brute_digests(doc_id, text):
    words = periodic_runs.split_words(text)
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words, 6, 4)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=None)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()), sha(kept))


def test_run_query_equals_brute_force(spark):
    docs = [r for r in given(spark) if r[1] is None or len(r[1]) < 6000]
    got = periodic_runs.run_digests(spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long"))
    want = ordered(brute_digests(r[0], r[1]) for r in docs)
    assert ordered(map(tuple, got.collect())) == want
    assert sum(r[1] for r in want) > 5
    assert queries.QUERIES["op11_periodic_runs"](spark, SMALL).count() == len(given(spark))


def test_runs_of_odd_rows(spark):
    got = periodic_runs.collapse_runs(odd_docs(spark))
    assert set(got.columns) == {*odd_docs(spark).columns, "runs", "collapsed"} and got.count() == 10
    by_text = {r.text: r for r in got.collect()}
    assert by_text[None].runs == [] and by_text[None].collapsed == "" == by_text[""].collapsed
    assert [tuple(x) for x in by_text["w " * 30000].runs] == [(0, 30000, 1)] and by_text["w " * 30000].collapsed == "w"
    assert by_text["x y z " * 9].collapsed == "x y z"
    assert by_text["A b c\x1cd é"].collapsed == "A b c\x1cd é"
    assert periodic_runs.collapse_runs(empty_docs(spark)).count() == 0
    assert periodic_runs.run_digests(odd_docs(spark)).filter("doc_id is null").count() == 2


# --- SimHash --------------------------------------------------------------------------------------------


def brute_print(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(docs):
    prints = [brute_print(t) for _, t in docs]
    arr = np.array(prints, "uint64")
    parent = list(range(len(docs)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in np.flatnonzero(np.bitwise_count(arr ^ arr[i]) <= 2):
            parent[find(int(j))] = find(i)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return ordered((d, f"{p:016x}", least.get(find(i))) for i, ((d, _), p) in enumerate(zip(docs, prints)))


def test_simhash_query_equals_brute_force(spark):
    got = queries.QUERIES["op12_simhash_ball"](spark, SMALL)
    assert ordered(map(tuple, got.collect())) == brute_components([r[:2] for r in given(spark)])


def test_simhash_of_odd_rows(spark):
    odd = odd_docs(spark)
    got = ordered(map(tuple, simhash_ball.near_duplicates(odd).collect()))
    assert got == brute_components([(r.doc_id, r.text) for r in odd.collect()])
    assert simhash_ball.near_duplicates(empty_docs(spark)).count() == 0


def test_near_pairs_hold_every_link(spark):
    r = random.Random(3)
    prints = {r.getrandbits(64) for _ in range(50)}
    for p in list(prints):
        for _ in range(12):  # chains of one to three changed bits
            for _ in range(r.randint(1, 3)):
                p ^= 1 << r.randrange(64)
            prints.add(p)
    signed = [simhash_ball._signed(p) for p in prints]
    for radius in (0, 2):
        docs = [(i, p) for i, p in enumerate(signed)]
        links = simhash_ball.near_pairs(spark.createDataFrame([(p,) for p in signed], "p long"), radius).collect()
        assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= radius for a, b in links)
        parent = {p: p for _, p in docs}

        def find(p):
            while parent[p] != p:
                p = parent[p]
            return p

        for a, b in links:
            parent[find(a)] = find(b)
        for _, a in docs:
            for _, b in docs:
                if ((a ^ b) & (1 << 64) - 1).bit_count() <= radius:
                    assert find(a) == find(b)
    with pytest.raises(ValueError):
        simhash_ball.near_pairs(spark.createDataFrame([(1,)], "p long"), 3)


def test_large_groups_of_copies(spark, monkeypatch):
    monkeypatch.setattr(simhash_ball, "LEAST_PIECE", 50)
    texts = ["a b c d e f g"] * 700 + [f"own words {i} of text {i * 7}" for i in range(300)]
    got = simhash_ball.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert ordered(map(tuple, got.collect())) == brute_components(list(enumerate(texts)))


# --- Merkle manifest ------------------------------------------------------------------------------------


@pytest.mark.parametrize("height", range(9))
def test_addresses_are_a_recursive_order(height):
    def layout(top, levels):
        """Nodes (depth, index) below ``top`` in van Emde Boas order, by the recursive definition."""
        if levels == 1:
            return [top]
        half = levels // 2
        out = layout(top, half)
        for i in range(1 << half):
            out += layout((top[0] + half, (top[1] << half) + i), levels - half)
        return out

    for place, (depth, index) in enumerate(layout((0, 0), height + 1)):
        assert merkle_veb.address(height + 1, depth, np.array([index]))[0] == place


@pytest.mark.parametrize("count", [1, 2, 3, 5, 8, 13])
def test_blocks_give_every_proof(count):
    leaves = [merkle_veb.node(str(i)) for i in range(count)]
    height = merkle_veb.height_of(count)
    b = merkle_veb.Block.build(leaves, height)
    again = merkle_veb.Block.read(height, count, b.cells.tobytes())
    assert again.level(0) == leaves
    for leaf, steps in zip(leaves, again.steps()):
        assert merkle_veb.fold(leaf, steps) == b.root() and len(steps) == height
        assert height == 0 or merkle_veb.fold(merkle_veb.node("other"), steps) != b.root()


def brute_proofs(docs):
    """Rows of (doc_id, text, lang, source, n_chars)."""
    enc = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda d, t, la, s, n: merkle_veb.node("".join(map(enc, (d, s, la, n, t))))
    parts = {}
    for r in docs:
        parts.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(*r), r))

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([merkle_veb.node(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
        return out

    def climb(cur, i, tree, proof):
        for level in tree[:-1]:
            near = [level[i ^ 1]] if i ^ 1 < len(level) else []
            proof += near
            cur = merkle_veb.node(*([cur, *near] if i % 2 == 0 else [*near, cur]))
            i //= 2
        return cur

    langs = sorted(parts, key=lambda x: (x is not None, (x or "").encode()))
    trees = {la: levels([x[2] for x in sorted(parts[la], key=lambda x: x[:3])]) for la in langs}
    top, out = levels([trees[la][-1][0] for la in langs]), []
    for k, la in enumerate(langs):
        for i, (_, _, own, r) in enumerate(sorted(parts[la], key=lambda x: x[:3])):
            hit = r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            proof = []
            end = climb(climb(leaf(*r[:4], r[4] + 1) if hit else own, i, trees[la], proof), k, top, proof)
            out.append((r[0], own, trees[la][-1][0], top[-1][0], merkle_veb.node(*proof), end, end == top[-1][0]))
    return ordered(out)


@pytest.mark.parametrize("bits", [12, 2])
def test_manifest_equals_brute_force(spark, monkeypatch, bits):
    monkeypatch.setattr(merkle_veb, "BLOCK_BITS", bits)
    got = ordered(map(tuple, queries.QUERIES["op13_merkle_veb"](spark, SMALL).collect()))
    assert got == brute_proofs(given(spark))
    assert {r[-1] for r in got} == {True, False}


def test_manifest_of_odd_rows(spark):
    odd = odd_docs(spark)
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    got = ordered(map(tuple, merkle_veb.document_proofs(odd, hit).collect()))
    assert got == brute_proofs([tuple(r)[:5] for r in odd.collect()])
    assert merkle_veb.document_proofs(empty_docs(spark), hit).count() == 0


def test_manifest_equals_its_sql(spark, con):
    from oracle.compare import difference

    assert difference(queries.QUERIES["op13_merkle_veb"](spark, SMALL), con, queries.ORACLE_SQL["op13_merkle_veb"]) == ""
