"""Words and word shingles of whole texts as numpy hashes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SHINGLE = 5
MAX_WORDS = 250_000
LONG = 64  # bytes; longer words are hashed one by one
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_LOW = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)  # keeps the first k of eight bytes
# Every ASCII character that is neither letter nor digit reads as a blank.
_PLAIN = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def mix(h: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values one to one."""
    h = (h ^ (h >> np.uint64(30))) * _MIX1
    h = (h ^ (h >> np.uint64(27))) * _MIX2
    return h ^ (h >> np.uint64(31))


def plain_words(text: str | None) -> list[bytes]:
    """Words without case and ASCII punctuation."""
    return text.lower().encode().translate(_PLAIN).split() if text else []


class WordHashes:
    """64-bit hashes of words; remembers them, and forgets all when there are too many."""

    def __init__(self, most: int = MAX_WORDS):
        self.known: dict[bytes, int] = {}
        self.most = most

    def __call__(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        found = [known.get(w) for w in words]
        if None in found:
            if len(known) > self.most:
                known.clear()
            for i, h in enumerate(found):
                if h is None:
                    found[i] = known[words[i]] = xxhash.xxh3_64_intdigest(words[i])
        return np.array(found, dtype=np.uint64)


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` words; of all words as one if there are fewer."""
    if not len(h):
        return h
    n = min(n, len(h))
    out = np.zeros(len(h) - n + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            out = mix(out * _ODD + h[i : len(h) - n + 1 + i])
    return out


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text or binary column, one value after the other, and where each value begins (and the last ends)."""
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    wide = np.dtype(np.int64 if large else np.int32)
    _, offsets, data = column.buffers()
    if not len(column) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, wide, len(column) + 1, column.offset * wide.itemsize).astype(np.int64)
    return np.frombuffer(data, np.uint8, int(at[-1] - at[0]), int(at[0])), at - at[0]


def set_before(flags: np.ndarray) -> np.ndarray:
    """How many flags are set before each place, and in all."""
    out = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=out[1:])
    return out


def contract_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of many texts at once, and where the words of each text begin (and the last end).

    Words are runs of anything but ASCII white space, A to Z made small; a null has none.
    """
    data, offsets = flat_bytes(pc.fill_null(texts, "") if texts.null_count else texts)
    size = len(data)
    chars = np.zeros(size + 8, np.uint8)  # eight bytes can be read from any place
    chars[:size] = data
    chars |= (chars - np.uint8(65) < 26).view(np.uint8) << np.uint8(5)
    blank = np.ones(size + 2, bool)
    blank[1:-1] = (chars[:size] == 32) | (chars[:size] - np.uint8(9) < 5)
    edge = np.zeros(size + 1, bool)  # between texts
    edge[offsets] = True
    starts = np.flatnonzero(~blank[1:-1] & (blank[:-2] | edge[:-1]))
    length = np.flatnonzero(~blank[1:-1] & (blank[2:] | edge[1:])) + 1 - starts
    eight = np.ndarray(size + 1, "<u8", chars, strides=(1,))
    h = mix((eight[starts] & _LOW[np.minimum(length, 8)]) + length.astype(np.uint64) * _ODD)
    more = np.flatnonzero((length > 8) & (length <= LONG))
    at = 8
    while len(more):
        h[more] = mix(h[more] * _ODD + (eight[starts[more] + at] & _LOW[np.minimum(length[more] - at, 8)]))
        at += 8
        more = more[length[more] > at]
    for i in np.flatnonzero(length > LONG):
        h[i] = xxhash.xxh3_64_intdigest(chars[starts[i] : starts[i] + length[i]])
    return h, np.searchsorted(starts, offsets)


def shingle_sets(h: np.ndarray, at: np.ndarray, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes, ascending within a text, of every run of ``n`` words; of all words as one if there are fewer.

    Takes the words of many texts and gives the sets in the same way. The words are hashes already, so a sum with
    odd factors tells their runs apart; it is scrambled once.
    """
    words = np.diff(at)
    runs = np.zeros(len(h), dtype=np.uint64)
    whole = max(len(h) - n + 1, 0)
    runs[:whole] = _run_hashes([h[k : whole + k] for k in range(n)])
    kept = np.ones(len(h), bool)
    for k in range(1, n):
        few = at[:-1][words == k]
        runs[few] = _run_hashes([h[few + j] for j in range(k)])
        kept[at[1:][words > k] - k] = False  # no whole run begins here, unless it is a short text's first word
    starts = set_before(kept)[at]
    runs = runs[kept]
    for s, e in zip(starts[:-1].tolist(), starts[1:].tolist()):
        runs[s:e].sort()
    first = np.ones(len(runs) + 1, bool)
    first[1:-1] = runs[1:] != runs[:-1]
    first[starts] = True
    return runs[first[:-1]], set_before(first[:-1])[starts]


def _run_hashes(words: list[np.ndarray]) -> np.ndarray:
    """Hash of every run of words whose first, second and further words are given."""
    out = words[0]
    for w in words[1:]:
        out = out * _ODD + w
    return mix(out)
