"""Periodic runs of words by online dyadic square catching.

A square is a stretch whose two halves are equal; squares of one period that overlap merge into a run, a stretch
with that smallest period which no neighbouring word extends. Words are appended in any portions. Over every
completed aligned block of ``b = 2**k`` words stands a catcher for the periods from ``2b-1`` to ``4b-2``: the first
half of any square of such a period holds one of these blocks whole, so the block comes again in the second half. A
catcher looks for its block among the stretches that the appended words complete, by prefix hashes; a hit is
compared word by word to both sides, and comparisons that reach the last word go on with the next portion. Hits
within a run that explains them (its period divides theirs) are left out, so highly periodic texts stay cheap: the
work is some array steps of the length of the text for each power of two.

Hashes only propose: every word of a reported run has been compared. Everything is held per text, a few numbers
a word.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterable, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemark.llm.common import append_columns

MIN_LENGTH, MIN_EXPONENT = 6, 4
PORTION = 1 << 16  # words appended at once
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)

Run = tuple[int, int, int]  # start, length, period


def _scattered(ids: np.ndarray) -> np.ndarray:
    """A fixed random-looking 64-bit number per word id."""
    z = ids.astype("uint64") * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def _powers(base: int, first: int, count: int) -> np.ndarray:
    out = np.full(count, base, "uint64")
    if count:
        out[0] = pow(base, first, 1 << 64)
    return np.multiply.accumulate(out)


def _grown(old: np.ndarray, size: int) -> np.ndarray:
    if size <= len(old):
        return old
    new = np.zeros(max(size, 2 * len(old)), old.dtype)
    new[: len(old)] = old
    return new


class SquareCatcher:
    """Runs of at least ``exponent`` periods in a sequence of word ids that grows at its end."""

    def __init__(self, exponent: int = 2):
        self.exponent = max(2, exponent)
        self.n = 0
        self.word = np.zeros(0, "int64")
        self.sums = np.zeros(1, "uint64")  # prefix hashes
        self.inverse = np.zeros(0, "uint64")
        self.blocks: list[np.ndarray] = []  # per level, the hashes of the completed aligned blocks
        self.open: dict[int, tuple[int, int]] = {}  # period -> stretch that reaches the last word
        self.found: dict[int, list[tuple[int, int]]] = {}  # period -> closed stretches of two periods or more

    def append(self, ids: Sequence[int] | np.ndarray) -> None:
        ids = np.asarray(ids, "int64")
        if not len(ids):
            return
        old, self.n = self.n, self.n + len(ids)
        n = self.n
        self.word, self.sums, self.inverse = _grown(self.word, n), _grown(self.sums, n + 1), _grown(self.inverse, n)
        self.word[old:n] = ids
        self.inverse[old:n] = _powers(_INVERSE, old, n - old)
        steps = _scattered(ids) * _powers(_BASE, old, n - old)
        self.sums[old + 1 : n + 1] = self.sums[old] + np.cumsum(steps, dtype="uint64")
        going, self.open = self.open, {}
        for period, (start, end) in going.items():
            self._keep(period, start, self._right(end, period))
        level, b = 0, 1
        # A run has exponent * period words, and a catcher's periods begin at 2b-1.
        while self.exponent * (2 * b - 1) <= n:
            self._level(level, b, old)
            level, b = level + 1, 2 * b

    def _hashes(self, starts: np.ndarray | slice, ends: np.ndarray | slice) -> np.ndarray:
        return (self.sums[ends] - self.sums[starts]) * self.inverse[starts]

    def _level(self, level: int, b: int, old: int) -> None:
        """Catchers of the blocks of ``b`` words against the stretches completed by the last portion."""
        if level == len(self.blocks):
            self.blocks.append(np.zeros(0, "uint64"))
        known, whole = len(self.blocks[level]), self.n // b
        if whole > known:
            starts = np.arange(known, whole) * b
            self.blocks[level] = np.concatenate([self.blocks[level], self._hashes(starts, starts + b)])
        # A level that begins late looks at all stretches, later on only at new ones.
        low, high = (0 if known == 0 else max(0, old - b + 1)), self.n - b + 1
        if high <= low:
            return
        stretch = self._hashes(slice(low, high), slice(low + b, high + b))
        hits = []
        for least in (2 * b - 1, 3 * b - 1):  # two blocks may stand at a distance of the catchers' periods
            s0 = max(low, least)
            if s0 >= high:
                continue
            first = (s0 - least) // b
            skip = (s0 - least) - first * b
            block = np.repeat(self.blocks[level][first : (high - 1 - least) // b + 1], b)[skip : skip + high - s0]
            at = np.flatnonzero(block == stretch[s0 - low :])
            if len(at):
                s = at + s0
                hits.append((s, (s - least) // b * b))
        if hits:
            s, j = (np.concatenate(x) for x in zip(*hits))
            self._compare(s, j, b)

    def _compare(self, s: np.ndarray, j: np.ndarray, b: int) -> None:
        """Hits of the block at ``j`` at ``s``: comparisons to both sides, those that a run explains left out."""
        left = ~self._within([p for p in self._periods() if p <= b], j, s + b)
        s, q = s[left], (s - j)[left]
        order = np.lexsort((s, q))
        s, q = s[order], q[order]
        for period in np.unique(q).tolist():
            lo, hi = np.searchsorted(q, period, "left"), np.searchsorted(q, period, "right")
            at = s[lo:hi]
            divisors = [p for p in (period // 2, period // 3) if p and period % p == 0 and p > b]
            at = at[~self._within(divisors, at - period, at + b)]
            if b == 1:
                at = self._long_enough(at, period)
            i = 0
            while i < len(at):
                here = int(at[i])
                stretch = self.open.get(period)
                if stretch is None or stretch[1] <= here:
                    end = self._right(here, period)
                    if end >= here + b:  # else equal hashes of different words
                        start = self._left(here, period) - period
                        self._keep(period, start, end)
                    else:
                        end = here + 1
                else:
                    end = stretch[1]
                i = int(np.searchsorted(at, end, "left"))

    def _long_enough(self, at: np.ndarray, period: int) -> np.ndarray:
        """First hits of neighbouring single-word hits that can be part of a run, told by their number alone."""
        if not len(at):
            return at
        first = np.flatnonzero(np.concatenate([[True], np.diff(at) > 1]))
        count = np.diff(np.concatenate([first, [len(at)]]))
        begin = at[first]
        keep = (count >= (self.exponent - 1) * period) | (begin + count == self.n)
        keep[0] = True  # may go on from the portion before
        return begin[keep]

    def _periods(self) -> list[int]:
        return list(self.found.keys() | self.open.keys())

    def _within(self, periods: Iterable[int], start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Whether one run of these periods holds the words from ``start`` to ``end``, per hit."""
        runs = [r for p in periods for r in self._of(p)]
        if not runs or not len(start):
            return np.zeros(len(start), bool)
        runs.sort()
        starts, ends = np.array(runs, "int64").T
        furthest = np.concatenate([[0], np.maximum.accumulate(ends)])
        return furthest[np.searchsorted(starts, start, "right")] >= end

    def _of(self, period: int) -> list[tuple[int, int]]:
        runs = self.found.get(period, [])
        going = self.open.get(period)
        return [*runs, going] if going is not None and going[1] - going[0] >= 2 * period else runs

    def _keep(self, period: int, start: int, end: int) -> None:
        if end == self.n:
            self.open[period] = (start, end)
        elif end - start >= 2 * period:
            runs = self.found.setdefault(period, [])
            if not runs or runs[-1] != (start, end):
                runs.append((start, end))

    def _right(self, i: int, period: int) -> int:
        """First place from ``i`` on whose word differs from the one a period before; the end if none does."""
        step = 64
        while i < self.n:
            stop = min(i + step, self.n)
            differs = self.word[i:stop] != self.word[i - period : stop - period]
            k = int(differs.argmax())
            if differs[k]:
                return i + k
            i, step = stop, 2 * step
        return self.n

    def _left(self, i: int, period: int) -> int:
        """First place of the equal words that end at ``i``."""
        step = 64
        while i > period:
            begin = max(i - step, period)
            differs = (self.word[begin:i] != self.word[begin - period : i - period])[::-1]
            k = int(differs.argmax())
            if differs[k]:
                return i - k
            i, step = begin, 2 * step
        return period

    def runs(self, least: int = MIN_LENGTH) -> list[Run]:
        """Runs so far with their smallest periods, by start, then period."""
        smallest: dict[tuple[int, int], int] = {}
        for period in self._periods():
            for start, end in self._of(period):
                if end - start >= max(least, self.exponent * period):
                    smallest[start, end] = min(period, smallest.get((start, end), period))
        return sorted((start, end - start, period) for (start, end), period in smallest.items())


def find_runs(words: Sequence[bytes], least: int = MIN_LENGTH, exponent: int = MIN_EXPONENT, portion: int = PORTION) -> list[Run]:
    """Runs of at least ``least`` words and ``exponent`` periods."""
    if len(words) < max(least, exponent):
        return []
    ids: dict[bytes, int] = {}
    catcher = SquareCatcher(exponent)
    for low in range(0, len(words), portion):
        catcher.append([ids.setdefault(w, len(ids)) for w in words[low : low + portion]])
    return catcher.runs(least)


def collapse(words: Sequence[bytes], runs: Sequence[Run]) -> list[bytes]:
    """The words without those that stand in a run after its first period."""
    if not runs:
        return list(words)
    edge = np.zeros(len(words) + 1, "int64")
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
    return [words[i] for i in kept.tolist()]


def split_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` in UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def strongest(runs: Sequence[Run]) -> Run | None:
    """The run with the most periods, exactly; ties go to the smaller start, then the smaller period."""
    best = None
    for r in runs:  # in order of start and period
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


Edit = Callable[[list[bytes], object], list[bytes]]


def collapse_runs(docs: DataFrame, text: str = "text", *, edit: Edit | None = None, by: str | None = None) -> DataFrame:
    """The rows with ``runs`` (start, length, period, in words from 0) and ``collapsed``, the kept words joined by blanks.

    Both replace columns of these names; all others stay. NULL and empty texts have no runs and collapse to empty
    text. Rows are looked at one by one, so repeated rows get equal results. ``edit`` may change the words of a row
    first, given the value of column ``by``.
    """

    def make() -> Callable:
        def columns(texts, keys=None):
            runs, kept = [], []
            for t, k in zip(texts, keys or texts):
                words = split_words(t)
                if edit is not None:
                    words = edit(words, k)
                found = find_runs(words)
                runs.append([{"start": s, "length": n, "period": p} for s, n, p in found])
                kept.append(b" ".join(collapse(words, found)).decode("utf-8", "surrogatepass"))
            return [runs, kept]

        return columns

    source = [text] if by is None else [text, by]
    return append_columns(docs, source, "runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string", make)


def planted(words: list[bytes], doc_id: object) -> list[bytes]:
    """The words of a document, those of every tenth (by crc32 of its id) periodic from some place on; ids may be NULL."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n = len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def run_digests(docs: DataFrame) -> DataFrame:
    """Per document its number of runs, the strongest one, and digests of all runs and of the collapsed words."""

    def make() -> Callable:
        def columns(texts, ids):
            out = [[] for _ in range(7)]
            for t, i in zip(texts, ids):
                words = planted(split_words(t), i)
                runs = find_runs(words)
                best = strongest(runs) or (None, None, None)
                exponent = None if best[0] is None else 1000 * best[1] // best[2]
                lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
                kept = b" ".join(collapse(words, runs))
                row = (len(runs), *best, exponent, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())
                for column, v in zip(out, row):
                    column.append(v)
            return out

        return columns

    added = "n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string"
    found = append_columns(docs.select("doc_id", "text"), ["text", "doc_id"], added, make)
    return found.select("doc_id", *[F.col(c) for c in ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")])
