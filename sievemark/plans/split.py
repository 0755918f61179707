"""Splitting a record set by size, into a number of parts, or without breaking key groups.

Rows are numbered by fixed ranges of their order, or, in the order in which files hold them, by the blocks of the
files, so no copy of the rows is written in between and a task that runs again numbers its rows alike.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sievemark.operators.keyed import join_key_statistic
from sievemark.operators.ordered import numbered, order_rows
from sievemark.session import cut_lineage, plan_nodes
from sievemark.sources.readers import split_fields

_LOCAL_BITS = 33  # monotonically_increasing_id: partition number above, row number below
_NARROW = {"Project", "Filter", "Relation", "SubqueryAlias", "Generate"}
CHAIN_ENTRIES = 2_000_000  # steps of carry functions that one task holds at once, two functions at least


def with_position(df: DataFrame, order: Sequence[str] = (), name: str = "position", total: str | None = None) -> DataFrame:
    """Rows numbered from 1 in ``order``, or as they are stored, without sorting in one task."""
    if order:
        return numbered(df, order, name, total)
    return _numbered_as_stored(df, name, total)


def _reads_files(df: DataFrame) -> bool:
    """Whether the rows come from files by row-wise steps alone, so that each block is a stretch of one partition."""
    try:
        df.select("_metadata.file_path").schema
    except AnalysisException:
        return False
    return set(plan_nodes(df)) <= _NARROW


def _numbered_as_stored(df: DataFrame, name: str, total: str | None) -> DataFrame:
    """In files: by path, block and place in the block. Other frames: by partition, of a checkpoint of the rows.

    Splits of files are planned alike for every job, so numbers stay the same when a task runs again.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    spot = F.monotonically_increasing_id().alias("_spot")
    if _reads_files(df):
        placed = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"), spot)
    else:
        placed = cut_lineage(df.select("*", spot)).withColumns({"_file": F.lit(""), "_start": F.lit(0).cast("bigint")})
    placed = placed.withColumn("_part", F.shiftright("_spot", _LOCAL_BITS))
    blocks = placed.groupBy("_part", "_file", "_start").agg(F.min("_spot").alias("_first"), F.count("*").alias("_size"))
    # One row per block of a file, so these windows and the broadcast are bounded by the number of splits.
    before = Window.orderBy("_file", "_start", "_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_size").over(before), F.lit(0)) - F.col("_first") + 1
    offsets = blocks.select(
        F.col("_part").alias("_p"), F.col("_start").alias("_s"), F.xxhash64("_file").alias("_f"), shift.alias("_shift"), F.sum("_size").over(Window.partitionBy()).alias("_total")
    )
    same = (F.col("_part") == F.col("_p")) & (F.col("_start") == F.col("_s")) & (F.xxhash64("_file") == F.col("_f"))
    extra = [F.col("_total").alias(total)] if total else []
    return placed.join(F.broadcast(offsets), same).select(*columns, (F.col("_spot") + F.col("_shift")).cast("bigint").alias(name), *extra)


def split_by_size(df: DataFrame, n: int, order: Sequence[str] = (), name: str = "chunk") -> DataFrame:
    """Rows 1..n in chunk 0, the next n rows in chunk 1, and so on."""
    numbered = with_position(df, order, "_pos")
    return numbered.select(*df.columns, F.floor((F.col("_pos") - 1) / n).cast("bigint").alias(name))


def split_in(df: DataFrame, k: int, order: Sequence[str] = (), name: str = "chunk") -> DataFrame:
    """At most ``k`` chunks of equal size, the last one smaller."""
    numbered = with_position(df, order, "_pos", "_rows")
    size = F.ceil(F.col("_rows") / k)
    return numbered.select(*df.columns, F.floor((F.col("_pos") - 1) / size).cast("bigint").alias(name))


def drop_leading_short(df: DataFrame, position: str, fields: Column | str) -> DataFrame:
    """Drop the rows before the first one that has more than one field."""
    count = F.size(fields)
    first = df.agg(F.min(F.when(count > 1, F.col(position)))).first()[0]
    return df.filter(F.col(position) >= F.lit(first))


def split_by_group(df: DataFrame, keys: Sequence[str], n: int, name: str = "chunk") -> DataFrame:
    """Groups in key text order, whole groups per chunk, a chunk closed as soon as it has ``n`` rows.

    Only group sizes are looked at, in ranges of the key order. What a range does to a chunk that is open when it
    begins is a step function of the rows in that chunk. These functions are composed in a tree, each task holding
    at most ``CHAIN_ENTRIES`` steps (or two functions, whose steps are bounded by ``n`` and by the groups they stand
    for); then the open rows at the beginning of every range are handed down the tree, and every range numbers its
    own groups.
    """
    if n < 1:
        raise ValueError("a chunk needs at least one row")
    names = [f"_g{i}" for i in range(len(keys))]
    rows = df.select("*", *[F.coalesce(F.col(k).cast("string"), F.lit("")).alias(g) for k, g in zip(keys, names)])
    sizes = cut_lineage(rows.groupBy(*names).agg(F.count("*").alias("_size")))  # one row per group
    ranges = order_rows(sizes, names)
    runs = ranges.placed("_i").select(*names, "_size", F.col("_range").alias("run"), "_i")
    effects = cut_lineage(runs.groupBy("run").applyInArrow(_effect(n), _EFFECT))
    runs = runs.join(F.broadcast(_carries(effects).toDF("_r", "_carry", "_first")), F.col("run") == F.col("_r"))  # one row per range
    schema = T.StructType([*[sizes.schema[c] for c in (*names, "_size")], T.StructField(name, T.LongType())])
    placed = runs.select(*names, "_size", "run", "_i", "_carry", "_first").groupBy("run").applyInArrow(_number_groups(n, schema), schema)
    return join_key_statistic(rows, placed, names, "_size", weights=sizes).select(*df.columns, name)


def split_lines_by_group(lines: DataFrame, sep: str, group_by: Sequence[int], n: int, name: str = "chunk") -> DataFrame:
    """Text lines of :func:`read_lines` by the fields (from 1) of ``group_by``, leading lines without a second field dropped."""
    rows = split_fields(lines, sep)
    order = F.struct("file", "block", "line_order")
    first = rows.agg(F.min(F.when(F.size("fields") > 1, order)).alias("at")).first()["at"]
    if first is None:
        return lines.limit(0).withColumn(name, F.lit(None).cast("bigint"))
    at = [F.lit(v).cast(rows.schema[c].dataType).alias(c) for c, v in first.asDict().items()]
    rows = rows.filter(order >= F.struct(*at))
    keyed = rows.select(*lines.columns, *[F.get("fields", F.lit(i - 1)).alias(f"_k{i}") for i in group_by])
    return split_by_group(keyed, [f"_k{i}" for i in group_by], n, name).select(*lines.columns, name)


# Effect of a run on an open chunk of ``c`` rows: step ``i`` holds for ``threshold[i] <= c``, with the rows left
# open at the end and the chunks closed. Below the first threshold nothing closes and the chunk grows by ``total``.
_LONGS = T.ArrayType(T.LongType())
_EFFECT = T.StructType().add("run", T.IntegerType()).add("total", T.LongType()).add("threshold", _LONGS).add("carry", _LONGS).add("closed", _LONGS)
_CARRY = T.StructType().add("run", T.IntegerType()).add("carry", T.LongType()).add("first", T.LongType())
Effect = tuple[int, np.ndarray, np.ndarray, np.ndarray]


def _table(schema: T.StructType, columns: Sequence) -> pa.Table:
    arrow = to_arrow_schema(schema)
    return pa.Table.from_arrays([c.cast(f.type) if isinstance(c, pa.ChunkedArray) else pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)


def _thinned(threshold: np.ndarray, carry: np.ndarray, closed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Without steps that repeat the one before; of equal thresholds the last counts."""
    last = np.ones(len(threshold), bool)
    last[:-1] = threshold[1:] != threshold[:-1]
    threshold, carry, closed = threshold[last], carry[last], closed[last]
    new = np.ones(len(threshold), bool)
    new[1:] = (carry[1:] != carry[:-1]) | (closed[1:] != closed[:-1])
    return threshold[new], carry[new], closed[new]


def _effect(n: int):
    def effect(groups: pa.Table) -> pa.Table:
        groups = groups.sort_by("_i")
        ends = np.concatenate([[0], np.cumsum(groups.column("_size").to_numpy())])
        last = len(ends) - 1
        # From a chunk start at group i, the chunk closes before group nxt[i]; follow to the run's end.
        nxt = np.searchsorted(ends, ends + n, "left")
        ptr = np.where(nxt <= last, nxt, np.arange(last + 1))
        closed = (nxt <= last).astype("int64")
        while True:
            further = ptr[ptr]
            if np.array_equal(further, ptr):
                break
            closed = closed + closed[ptr]
            ptr = further
        open_rows = ends[last] - ends[ptr]
        # The open chunk can first close at group j = 1 .. stop.
        stop = min(int(np.searchsorted(ends, n, "left")), last)
        j = np.arange(stop, 0, -1)
        steps = _thinned(np.maximum(n - ends[j], 0), open_rows[j], closed[j] + 1)
        return _table(_EFFECT, [[groups.column("run")[0].as_py()], [int(ends[last])], *[[x] for x in steps]])

    return effect


def _after(effect: Effect, carry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows open after a run and chunks closed in it, for open rows before it."""
    total, threshold, carries, closed = effect
    step = np.searchsorted(threshold, carry, "right") - 1
    if not len(threshold):
        return carry + total, np.zeros(len(carry), "int64")
    return np.where(step < 0, carry + total, carries[step]), np.where(step < 0, 0, closed[step])


def _then(f: Effect, g: Effect) -> Effect:
    """The effect of one run after another."""
    below = f[1][0] if len(f[1]) else np.inf
    early = g[1] - f[0]  # g closes a chunk that f only lets grow
    early = early[early < below]
    begin = np.maximum(early, 0)
    after, closed = _after(g, begin + f[0])
    late, more = _after(g, f[2])
    return (f[0] + g[0], *_thinned(np.concatenate([begin, f[1]]), np.concatenate([after, late]), np.concatenate([closed, f[3] + more])))


def _effects_of(t: pa.Table) -> tuple[list[int], list[Effect]]:
    t = t.sort_by("run")
    arrays = [[np.asarray(v.values, "int64") for v in t.column(c).combine_chunks()] for c in ("threshold", "carry", "closed")]
    return t.column("run").to_pylist(), list(zip(t.column("total").to_pylist(), *arrays))


def _composed(t: pa.Table) -> pa.Table:
    runs, effects = _effects_of(t)
    out = effects[0]
    for e in effects[1:]:
        out = _then(out, e)
    return _table(_EFFECT, [[t.column("node")[0].as_py()], [out[0]], *[[x] for x in out[1:]]])


def _handed_down(t: pa.Table) -> pa.Table:
    """Open rows and chunk number at the beginning of each run of a node, from those of the node."""
    runs, effects = _effects_of(t)
    carry, first, out = np.array([t.column("_carry")[0].as_py()]), t.column("_first")[0].as_py(), []
    for run, e in zip(runs, effects):
        out.append((run, int(carry[0]), int(first)))
        carry, closed = _after(e, carry)
        first += int(closed[0])
    return _table(_CARRY, list(zip(*out)))


def _carries(effects: DataFrame) -> DataFrame:
    """(run, carry, first): rows of the chunk that is open when each run begins, and that chunk's number."""
    levels: list[DataFrame] = []
    while True:
        seen = effects.agg(F.count("*").alias("n"), F.max(F.size("threshold")).alias("steps")).first()
        if seen["n"] <= 1:
            break
        fan = int(max(2, CHAIN_ENTRIES // max(1, seen["steps"])))
        levels.append(effects.withColumn("node", F.floor(F.col("run") / fan).cast("int")))
        effects = cut_lineage(levels[-1].groupBy("node").applyInArrow(_composed, _EFFECT))
    starts = effects.select("run", F.lit(0).cast("bigint").alias("carry"), F.lit(0).cast("bigint").alias("first"))
    for level in reversed(levels):
        above = starts.toDF("_node", "_carry", "_first")
        starts = cut_lineage(level.join(above, F.col("node") == F.col("_node")).groupBy("node").applyInArrow(_handed_down, _CARRY))
    return starts


def _number_groups(n: int, schema: T.StructType):
    names = schema.names[:-1]

    def number(groups: pa.Table) -> pa.Table:
        groups = groups.sort_by("_i")
        carry, chunk = groups.column("_carry")[0].as_py(), groups.column("_first")[0].as_py()
        ends = np.cumsum(groups.column("_size").to_numpy())
        ids = np.empty(len(ends), "int64")
        start, base = 0, -carry
        while start < len(ends):
            stop = int(np.searchsorted(ends, base + n, "left"))
            ids[start : stop + 1] = chunk
            if stop >= len(ends):
                break
            chunk, base, start = chunk + 1, int(ends[stop]), stop + 1
        return _table(schema, [*[groups.column(c) for c in names], ids])

    return number
