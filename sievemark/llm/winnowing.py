"""Document fingerprints by winnowing, in DataFrame functions only.

A text is cut into words (runs of anything but white space, in small letters). Every run of ``GRAM`` words has
a 64-bit hash; of every ``WINDOW`` neighbouring hashes the smallest is chosen, the rightmost one among equal
ones, and kept once with its position. Any passage of GRAM + WINDOW - 1 words that two texts share therefore
leaves a common hash in both fingerprints, and the positions say where.

Null texts count as empty; a text without words has an empty fingerprint. One with fewer than GRAM words has
one hash of all of them, one with fewer than WINDOW hashes has the smallest of these. Equal texts have equal
fingerprints. The next document of a row is the one after it by (doc_id, text), rows without doc_id first;
after the last row comes the first. A single row is its own next.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GRAM = 4
WINDOW = 4
ROWS_PER_BUCKET = 400
MAX_BUCKETS = 1 << 16  # bounds the list of bucket borders


def _gram_hashes(words: Column, hashes: Column) -> Column:
    """Hash of every run of GRAM words; of all of them if there are fewer."""
    n = F.size(words)
    runs = F.transform(
        F.slice(hashes, 1, F.greatest(n - GRAM + 1, F.lit(0))),
        lambda h, i: F.xxhash64(h, *[F.get(hashes, i + k) for k in range(1, GRAM)]),
    )
    return F.when(n == 0, F.slice(hashes, 1, 0)).when(n < GRAM, F.array(F.xxhash64(hashes))).otherwise(runs)


def _chosen(grams: Column) -> Column:
    """(pos, hash) of the rightmost smallest hash of every window.

    A hash is chosen if some window holds it with no smaller hash on its left and only larger ones on its
    right, that is, if such neighbours on both sides together fill a window.
    """

    def pick(h: Column, i: Column) -> Column:
        left = [F.coalesce(F.get(grams, i - k) >= h, F.lit(False)) for k in range(1, WINDOW)]
        right = [F.coalesce(F.get(grams, i + k) > h, F.lit(False)) for k in range(1, WINDOW)]
        fits = reduce(or_, [reduce(and_, left[:a] + right[: WINDOW - 1 - a]) for a in range(WINDOW)])
        return F.when(fits, F.struct(i.alias("pos"), h.alias("hash")))

    least = F.array_min(grams)
    last = (F.size(grams) - F.array_position(F.reverse(grams), least)).cast("int")
    few = F.when(F.size(grams) > 0, F.array(F.struct(last.alias("pos"), least.alias("hash"))))
    many = F.filter(F.transform(grams, pick), lambda p: p.isNotNull())
    return F.when(F.size(grams) >= WINDOW, many).otherwise(F.coalesce(few, F.filter(F.transform(grams, pick), lambda p: F.lit(False))))


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """The rows with ``name``: array of (pos: first word of the run from 0, hash), by position."""
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() != name.lower()]
    words = F.filter(F.split(F.lower(F.coalesce(F.col(f"`{text}`"), F.lit(""))), r"\s+"), lambda w: w != "")
    df = df.select(*kept, words.alias("_words"))
    df = df.select(*kept, "_words", F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"))
    df = df.select(*kept, _gram_hashes(F.col("_words"), F.col("_hashes")).alias("_grams"))
    return df.select(*kept, _chosen(F.col("_grams")).alias(name))


def likeness(a: Column, b: Column) -> Column:
    """Twice the number of common distinct hashes over the numbers of both; 1 for two empty fingerprints."""
    a, b = F.array_distinct(a["hash"]), F.array_distinct(b["hash"])
    total = F.size(a) + F.size(b)
    return F.when(total == 0, F.lit(1.0)).otherwise(2.0 * F.size(F.array_intersect(a, b)) / F.greatest(total, F.lit(1)))


def as_text(fingerprint: Column) -> Column:
    return F.concat_ws(",", F.transform(fingerprint, lambda p: F.concat(p["pos"].cast("string"), F.lit(":"), F.lower(F.hex(p["hash"])))))


def _bucket(key: Column, borders: list[int]) -> Column:
    """Number of borders up to the key, found in two steps over lists of about the square root of their number."""
    step = max(1, int(len(borders) ** 0.5))
    if not borders:
        return F.lit(0)
    coarse = F.lit(np.array(borders[::step], dtype=np.int64))
    fine = F.lit(np.array(borders, dtype=np.int64))
    before = F.size(F.filter(coarse, lambda b: b <= key))
    part = F.slice(fine, F.greatest((before - 1) * step, F.lit(0)) + 1, step)
    return F.greatest(before - 1, F.lit(0)) * step + F.size(F.filter(part, lambda b: b <= key))


def _buckets(df: DataFrame, key: str, rows: int) -> DataFrame:
    """The rows with ``_bucket``: ascending ranges of the key with about ``rows`` rows each."""
    n = min(max(1, -(-df.count() // rows)), MAX_BUCKETS)
    parts = [i / n for i in range(1, n)]
    borders = df.agg(F.percentile_approx(key, parts, max(10_000, 10 * n)).alias("b")).first()["b"] if parts else []
    return df.withColumn("_bucket", _bucket(F.col(key), sorted(set(borders or []))))


def with_next(df: DataFrame, doc_id: str, columns: list[str], rows: int = ROWS_PER_BUCKET, prepare=lambda df: df) -> DataFrame:
    """(doc_id, columns, ``_next``: struct of columns of the row after it), all rows in one shuffle.

    Rows are dealt by ranges of doc_id and numbered on within a range; a copy of the first row of the
    following range is added at the end of each, so no step sees all rows in one task. ``prepare`` is
    applied to the dealt rows and may add columns, which ``_next`` then has too.
    """
    keyed = df.select(F.col(f"`{doc_id}`").alias("_id"), F.coalesce(F.col(f"`{doc_id}`").cast("bigint"), F.lit(-(2**63))).alias("_key"), *columns)
    dealt = _buckets(keyed, "_key", rows)
    firsts = dealt.groupBy("_bucket").agg(F.min("_key").alias("_first"))
    # One row per bucket, at most MAX_BUCKETS.
    around = Window.orderBy("_bucket")
    onward = F.coalesce(F.lead("_first").over(around), F.min("_first").over(Window.partitionBy()))
    ends = firsts.select(F.col("_bucket").alias("_b"), onward.alias("_onward"))
    extra = keyed.join(F.broadcast(ends), F.col("_key") == F.col("_onward"))
    extra = extra.groupBy("_b").agg(F.min_by(F.struct(*columns), F.struct(*columns)).alias("_c"))
    extra = extra.select(F.lit(None).cast(keyed.schema["_id"].dataType).alias("_id"), F.lit(2**63 - 1).alias("_key"), *[F.col(f"_c.{c}").alias(c) for c in columns], F.col("_b").alias("_bucket"), F.lit(True).alias("_end"))
    spread = dealt.withColumn("_end", F.lit(False)).unionByName(extra).repartition("_bucket")
    spread = prepare(spread)
    held = [c for c in spread.columns if c not in ("_id", "_key", "_bucket", "_end")]
    order = Window.partitionBy("_bucket").orderBy("_end", "_key", *columns)
    found = spread.withColumn("_next", F.lead(F.struct(*held)).over(order)).filter("not _end")
    return found.select(F.col("_id").alias(doc_id), *held, "_next")


def edited_fingerprints(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every text and its edited text (the last half replaced by the beginning of the next), fingerprinted."""
    docs = df.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    rows = with_next(docs, "doc_id", ["text"], prepare=lambda d: with_fingerprint(d, "text", "fp"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring(F.col("_next.text"), F.lit(1), half))
    rows = rows.select("doc_id", n.cast("bigint").alias("n_chars"), edited.alias("edited"), "fp", F.col("_next.fp").alias("next_fp"))
    rows = with_fingerprint(rows, "edited", "edited_fp")
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("fp")).alias("fingerprint"),
        as_text(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )
