"""SimHash near duplicates by meet-in-the-middle ball hashing.

The fingerprint of a text takes its words ``[^\\x20\\x09-\\x0D]+`` (A-Z in small letters), every run of three
of them (repeats included, all of them as one where there are fewer) and the XXH64 (seed 42) of each run; a bit
is one if more than half of the hashes have it. A NULL or empty text has fingerprint zero and is linked like any
other. Two fingerprints that differ in at most ``2 * h`` bits have a third one within ``h`` bits of both. So every
distinct fingerprint emits all variants within ``h`` bits, variants are shuffled, and those that meet on one are
verified and linked.

Copies are one fingerprint before anything is emitted. The fingerprints that meet on a variant are distinct and lie
in its ball, so at most ``len(ball(h))`` of them meet, however the texts are distributed. All of them are within
``2 * h`` bits of each other, so neighbours in their order are linked, not all pairs; components are the same.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievemark.llm.common import append_columns
from sievemark.llm.components import connected_components
from sievemark.operators.keyed import join_key_statistic
from sievemark.session import cut_lineage

BITS, SEED, RUN = 64, 42, 3
HEAVY_KEYS = 100_000  # most keys that are split into pieces when a result is joined back; they are broadcast
LEAST_PIECE = 4096  # rows
_SLICE = 1 << 16  # hashes counted at once


def simhash(text: str | None, words: int = RUN) -> int:
    """The fingerprint as an unsigned number."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not found:
        return 0
    joined, ends, at = b" ".join(found), [], -1
    for w in found:
        at += len(w) + 1
        ends.append(at)
    starts = [0, *[e + 1 for e in ends[:-1]]]
    width = min(words, len(found))
    digest = xxhash.xxh64_intdigest
    ones, total = np.zeros(BITS, "int64"), len(found) - width + 1
    for low in range(0, total, _SLICE):
        high = min(low + _SLICE, total)
        hashes = np.array([digest(joined[s:e], SEED) for s, e in zip(starts[low:high], ends[low + width - 1 : high + width - 1])], ">u8")
        ones += np.unpackbits(hashes.view("uint8").reshape(-1, 8), axis=1).sum(axis=0, dtype="int64")
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def _signed(n: int) -> int:
    return n - (1 << BITS) if n >> (BITS - 1) else n


def fingerprints(docs: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """The rows with their fingerprint as a (signed) bigint."""

    def make() -> Callable:
        return lambda texts: [[_signed(simhash(t)) for t in texts]]

    return append_columns(docs, [text], f"`{name}` bigint", make)


def ball(h: int) -> list[int]:
    """Masks of all changes of at most ``h`` bits."""
    return [_signed(sum(1 << b for b in c)) for k in range(h + 1) for c in combinations(range(BITS), k)]


def near_pairs(prints: DataFrame, radius: int = 2) -> DataFrame:
    """(a, b): links between distinct fingerprints, whose components are those of all pairs within ``radius`` bits.

    ``prints`` has one column of distinct fingerprints; ``radius`` is even.
    """
    if radius % 2:
        raise ValueError("the ball is half the radius wide, so the radius has to be even")
    one = prints.toDF("p")
    masks = F.array(*[F.lit(m).cast("bigint") for m in ball(radius // 2)])
    met = one.select("p", F.explode(masks).alias("m")).select("p", F.col("p").bitwiseXOR(F.col("m")).alias("v"))
    before = F.lag("p").over(Window.partitionBy("v").orderBy("p"))
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    return met.select(before.alias("a"), F.col("p").alias("b")).filter(F.col("a").isNotNull() & close).distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = 2) -> DataFrame:
    """(doc_id, fingerprint, component_id) per row: 16 hexadecimal digits and the smallest id of its component.

    Rows that repeat an id are rows of their own; a component without any id has NULL. Only fingerprints move
    after the first scan.
    """
    rows = cut_lineage(fingerprints(docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")), "_text", "_print").select("_id", "_print"))
    groups = cut_lineage(rows.groupBy("_print").agg(F.min("_id").alias("_least"), F.count("*").alias("_n")))
    # Checkpointed before links are made distinct twice; each round of the components reads its own links only.
    parts = connected_components(near_pairs(groups.select("_print"), radius))
    placed = groups.join(parts, F.col("_print") == F.col("node"), "left").select("_print", "_least", "_n", F.coalesce("component", "_print").alias("_root"))
    placed = cut_lineage(placed)
    # Fingerprints per component, then rows per fingerprint: either may be a third of all.
    sizes = placed.groupBy("_root").agg(F.min("_least").alias("component_id"), F.count("*").alias("_w"))
    of_print = join_key_statistic(placed.select("_print", "_n", "_root"), sizes, ["_root"], "_w", piece_rows=_piece(placed))
    of_print = cut_lineage(of_print.select("_print", "_n", "component_id"))
    out = join_key_statistic(rows, of_print, ["_print"], "_n", piece_rows=_piece(rows))
    digits = F.lower(F.lpad(F.hex("_print"), 16, "0"))
    return out.select(F.col("_id").alias(doc_id), digits.alias("fingerprint"), "component_id")


def _piece(rows: DataFrame) -> int:
    """Rows per piece of a heavy key, so that at most ``HEAVY_KEYS`` keys have more than one."""
    return max(LEAST_PIECE, rows.count() // HEAVY_KEYS)
