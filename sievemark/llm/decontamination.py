"""Benchmark decontamination by SimHash over item-sized windows.

Every window of a document, as long as the items of a size class, gets a 64-bit SimHash of its word pairs;
sums of the 64 bits are kept in byte lanes of eight 64-bit numbers, so a window costs two subtractions of
running sums. Items have the SimHash of their first and last window (long ones of all windows end to end).
A multi-index of four 16-bit blocks finds all fingerprints within ``RADIUS`` = 11 bits: two within 11 bits
differ by at most two bits in one block, and every block value within two bits of an item's block is
listed. Each candidate is checked exactly: the item and the document's window of the item's length must
share five-word shingles, weighted by their numbers, to a similarity (sum of minima over sum of maxima) of
0.8 or more.

Words ignore case and ASCII punctuation. Null or empty texts and items match nothing; items under five words
are one shingle and match only as they are. Repeated rows and items are reported each. An empty benchmark
or table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievemark.llm.common import append_columns, flat_rows
from sievemark.llm.shingles import SHINGLE, WordHashes, grams, plain_words

SIZES = (1, 2, 3, 4, 5, 6, 8, 12, 16, 24, 32, 48, 64)
RADIUS = 11
SIMILARITY = 0.8
MAX_ITEMS = 20_000  # items per pass over the documents; bounds the broadcast index
CHUNK_WORDS = 1 << 16
LANES = np.uint64(0x0101010101010101)
HIGH = np.uint64(0x8080808080808080)
NEAR = [0] + [1 << i for i in range(16)] + [1 << i | 1 << j for i, j in combinations(range(16), 2)]


def running_sums(h: np.ndarray) -> np.ndarray:
    """Running sums of the bits of the word-pair hashes, eight rows of byte lanes; row j has bits j, 8 + j, ..."""
    out = np.zeros((8, len(h) + 1), dtype=np.uint64)
    for j in range(8):
        np.cumsum((h >> np.uint64(j)) & LANES, out=out[j, 1:])
    return out


def fingerprints(sums: np.ndarray, n: int) -> np.ndarray:
    """SimHash of every run of ``n`` (up to 127) features: a bit is set where more than half of them have it."""
    lift = np.uint64(128 - (n // 2 + 1)) * LANES
    out = np.zeros(sums.shape[1] - n, dtype=np.uint64)
    for j in range(8):
        out |= ((sums[j, n:] - sums[j, :-n] + lift) & HIGH) >> np.uint64(7 - j)
    return out


def features(h: np.ndarray, size: int) -> tuple[np.ndarray, int]:
    """Hashes of word pairs (of words for one-word windows) and how many a window of ``size`` words has."""
    return (grams(h, 2), size - 1) if size > 1 else (grams(h, 1), 1)


class SizeClass:
    """Multi-index over the fingerprints of the items of one window size."""

    def __init__(self, size: int, prints: np.ndarray, items: np.ndarray, offsets: np.ndarray):
        self.size, self.prints, self.items, self.offsets = size, prints, items, offsets
        self.blocks = []
        near = np.array(NEAR, dtype=np.uint64)
        for b in range(4):
            keys = (((prints >> np.uint64(16 * b)) & np.uint64(0xFFFF))[:, None] ^ near).ravel().astype(np.int64)
            owner = np.repeat(np.arange(len(prints)), len(near))
            order = np.argsort(keys, kind="stable")
            first = np.searchsorted(keys[order], np.arange((1 << 16) + 1))
            self.blocks.append((np.diff(first) > 0, first, owner[order]))

    def near(self, prints: np.ndarray, valid: np.ndarray) -> list[tuple[int, int]]:
        """(window, fingerprint of an item) for all pairs within the radius."""
        found = set()
        for b, (flag, first, owner) in enumerate(self.blocks):
            keys = ((prints >> np.uint64(16 * b)) & np.uint64(0xFFFF)).astype(np.int64)
            hit = np.flatnonzero(flag[keys] & valid)
            for start in range(0, len(hit), 1 << 16):
                part = hit[start : start + (1 << 16)]
                low, n = first[keys[part]], first[keys[part] + 1] - first[keys[part]]
                windows = np.repeat(part, n)
                mine = owner[np.arange(len(windows)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)]
                close = np.bitwise_count(prints[windows] ^ self.prints[mine]) <= RADIUS
                found.update(zip(windows[close].tolist(), mine[close].tolist()))
        return sorted(found)


class LeakFinder:
    """Finds the items of one benchmark in texts."""

    def __init__(self, items: list[tuple], hashes: WordHashes | None = None):
        self.hashes = hashes or WordHashes()
        self.ids, self.words, self.shingles = [], [], []
        windows: dict[int, list[tuple[int, int, int]]] = {}
        for item_id, text in items:
            h = self.hashes(plain_words(text))
            if not len(h):
                continue
            at = len(self.ids)
            self.ids.append(item_id)
            self.words.append(len(h))
            self.shingles.append(Counter(grams(h, SHINGLE).tolist()))
            size = max(s for s in SIZES if s <= len(h))
            f, n = features(h, size)
            prints = fingerprints(running_sums(f), n)
            for offset in sorted({*range(0, len(h) - size + 1, size), len(h) - size}):
                windows.setdefault(size, []).append((int(prints[offset]), at, offset))
        self.classes = []
        for size, found in sorted(windows.items()):
            prints, of, offsets = zip(*found)
            self.classes.append(SizeClass(size, np.array(prints, dtype=np.uint64), np.array(of), np.array(offsets)))

    def similarity(self, item: int, h: np.ndarray) -> float:
        mine, other = self.shingles[item], Counter(grams(h, SHINGLE).tolist())
        shared = sum((mine & other).values())
        return shared / (sum(mine.values()) + sum(other.values()) - shared)

    def find(self, texts: list[str | None]) -> list[list[tuple[object, float, int, int]]]:
        """Per text: (item id, similarity, first word, words) of the best window of each item that it contains."""
        out: list[list] = []
        held: list[np.ndarray] = []
        words = 0
        for t in texts:
            held.append(self.hashes(plain_words(t)))
            words += len(held[-1])
            if words >= CHUNK_WORDS:
                out += self._find(held)
                held, words = [], 0
        return out + self._find(held) if held else out

    def _find(self, docs: list[np.ndarray]) -> list[list]:
        best: list[dict[int, tuple[float, int]]] = [{} for _ in docs]
        ends = np.cumsum([len(d) for d in docs])
        h = np.concatenate(docs)
        owner = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
        last = ends[owner] if len(h) else np.zeros(0, int)
        sums: dict[bool, np.ndarray] = {}
        for c in self.classes:
            if len(h) < c.size:
                continue
            f, n = features(h, c.size)
            if (c.size > 1) not in sums:
                sums[c.size > 1] = running_sums(f)
            prints = fingerprints(sums[c.size > 1], n)
            valid = np.arange(len(prints)) + c.size <= last[: len(prints)]
            tried = set()
            for window, fp in c.near(prints, valid):
                item, doc = int(c.items[fp]), int(owner[window])
                begin = int(ends[doc]) - len(docs[doc])
                start = max(window - int(c.offsets[fp]), begin)
                if (item, start) in tried:
                    continue
                tried.add((item, start))
                s = self.similarity(item, h[start : min(start + self.words[item], int(ends[doc]))])
                if s >= SIMILARITY and (-s, start) < best[doc].get(item, (1.0, 0)):
                    best[doc][item] = (-s, start)
        out = []
        for doc, items in enumerate(best):
            begin = int(ends[doc]) - len(docs[doc])
            out.append([(self.ids[i], -s, start - begin, self.words[i]) for i, (s, start) in sorted(items.items())])
        return out


def _passes(benchmark: DataFrame, item_id: str, text: str, most: int) -> list[list[tuple]]:
    """The items in lists of about ``most``, each small enough to broadcast."""
    items = benchmark.select(item_id, text).filter(F.col(text).isNotNull())
    parts = -(-items.count() // most)
    spread = F.pmod(F.xxhash64(item_id, text), F.lit(max(parts, 1)))
    return [[tuple(r) for r in items.filter(spread == p).orderBy(item_id, text).collect()] for p in range(parts)]


def find_leaks(df: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", most: int = MAX_ITEMS) -> DataFrame:
    """One row per document row and benchmark item that it contains: similarity, first word and length of the window."""
    ids = [T.StructField(doc_id, df.schema[doc_id].dataType), T.StructField(item_id, benchmark.schema[item_id].dataType)]
    rest = [("similarity", T.DoubleType()), ("first_word", T.LongType()), ("n_words", T.LongType())]
    schema = T.StructType([*ids, *[T.StructField(n, t) for n, t in rest]])
    found = df.sparkSession.createDataFrame([], schema)
    for items in _passes(benchmark, item_id, item_text, most):
        shared = df.sparkSession.sparkContext.broadcast(items)

        def make(shared=shared):
            finder = LeakFinder(shared.value)

            def run(keys, texts):
                for key, leaks in zip(keys, finder.find(texts)):
                    for leak in leaks:
                        yield key, *leak

            return run

        found = found.unionByName(flat_rows(df, [doc_id, text], schema, make))
    return found


def drop_leaks(df: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", most: int = MAX_ITEMS) -> DataFrame:
    """The rows whose text contains no item."""
    columns = df.columns
    for items in _passes(benchmark, item_id, item_text, most):
        shared = df.sparkSession.sparkContext.broadcast(items)

        def make(shared=shared):
            finder = LeakFinder(shared.value)
            return lambda texts: [[bool(leaks) for leaks in finder.find(texts)]]

        df = append_columns(df, [text], "_leaks boolean", make).filter("not _leaks")
    return df.select(*[F.col(f"`{c}`") for c in columns])
