"""Shared helpers of the operators: table reading, Arrow-batched column functions, rows found in texts."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

Columns = list[list]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _schema(ddl: str | T.StructType) -> T.StructType:
    return ddl if isinstance(ddl, T.StructType) else T._parse_datatype_string(ddl)


def append_columns(
    df: DataFrame, source: Sequence[str], added: str | T.StructType, make: Callable[[], Callable[..., Columns]], drop: bool = False
) -> DataFrame:
    """The rows with further columns, computed batch by batch in Python.

    ``make`` is called once per task; what it returns gets the ``source`` columns of a batch as lists and
    gives one list per added column. An added column replaces one of the same name; all others stay, but
    with ``drop`` the source columns go: they are sent to Python once and do not come back.
    """
    added = _schema(added)
    names = {f.name.lower() for f in added} | {c.lower() for c in source if drop}
    kept = [f for f in df.schema if f.name.lower() not in names]
    schema = T.StructType([*kept, *added])
    # Sources travel under free names of their own, so a source that is replaced can still be read.
    sign = "_in"
    while any(f.name.lower().startswith(sign) for f in kept):
        sign += "_"
    sent = df.select(*[F.col(f"`{f.name}`") for f in kept], *[F.col(f"`{c}`").alias(f"{sign}{i}") for i, c in enumerate(source)])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for b in batches:
            for piece in _pieces(b, len(kept)):
                out = f(*[piece.column(len(kept) + i).to_pylist() for i in range(len(source))])
                arrays = [piece.column(i).cast(arrow.field(i).type) for i in range(len(kept))]
                arrays += [pa.array(c, arrow.field(len(kept) + i).type) for i, c in enumerate(out)]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)
        f = out = arrays = piece = b = None
        give_back_memory()

    return sent.mapInArrow(run, schema)


@contextmanager
def without_collection() -> Iterator[None]:
    """No search for cycles meanwhile; for code that makes many small objects and no cycles."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


def give_back_memory() -> None:
    """Returns what a task has freed to the system, as its Python worker goes on to serve other stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def _pieces(b: pa.RecordBatch, kept: int, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of about 4 MB each, so that Python objects of one slice stay bounded; one row at least."""
    rows = max(1, int(b.num_rows * most / max(b.nbytes, 1)))
    for start in range(0, b.num_rows, rows):
        yield b.slice(start, rows)


def flat_rows(df: DataFrame, source: Sequence[str], schema: str | T.StructType, make: Callable[[], Callable[..., Iterator[tuple]]], size: int = 20_000) -> DataFrame:
    """Any number of rows for the ``source`` columns of a batch; ``make()`` gives a generator of tuples."""
    schema = _schema(schema)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        held: list[tuple] = []
        for b in batches:
            for piece in _pieces(b, 0):
                for row in f(*[piece.column(i).to_pylist() for i in range(len(source))]):
                    held.append(row)
                    if len(held) >= size:
                        yield _batch(held, arrow)
                        held = []
        if held:
            yield _batch(held, arrow)
        f = held = piece = b = None
        give_back_memory()

    return df.select(*[F.col(f"`{c}`").alias(f"_in{i}") for i, c in enumerate(source)]).mapInArrow(run, schema)


def _batch(rows: list[tuple], arrow: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)


def array_rows(df: DataFrame, source: Sequence[str], schema: str | T.StructType, make: Callable[[], Callable[..., Sequence]]) -> DataFrame:
    """As :func:`flat_rows`, for functions that give one numpy array per output column for a whole batch."""
    schema = _schema(schema)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for b in batches:
            for piece in _pieces(b, 0):
                out = f(*[piece.column(i).to_pylist() for i in range(len(source))])
                yield pa.RecordBatch.from_arrays([pa.array(c, x.type) for c, x in zip(out, arrow)], schema=arrow)
        f = out = piece = b = None
        give_back_memory()

    return df.select(*[F.col(f"`{c}`").alias(f"_in{i}") for i, c in enumerate(source)]).mapInArrow(run, schema)


def arrow_rows(df: DataFrame, source: Sequence[str], schema: str | T.StructType, make: Callable[[], Callable[..., Sequence]], most: int = 1 << 20) -> DataFrame:
    """As :func:`array_rows`, for functions that take the ``source`` columns as Arrow arrays, of about ``most`` bytes in
    all, and give numpy or Arrow arrays. Pieces are small, so that what is made of them stays in the processor's cache."""
    schema = _schema(schema)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for b in batches:
            for piece in _pieces(b, 0, most):
                out = f(*[piece.column(i) for i in range(len(source))])
                yield pa.RecordBatch.from_arrays([c.cast(x.type) if isinstance(c, pa.Array) else pa.array(c, x.type) for c, x in zip(out, arrow)], schema=arrow)
        f = out = piece = b = None
        give_back_memory()

    return df.select(*[F.col(f"`{c}`").alias(f"_in{i}") for i, c in enumerate(source)]).mapInArrow(run, schema)


def fold(key: Column | str, parts: int) -> Column:
    """crc32 of the key as text, modulo ``parts``; NULL keys count as empty text."""
    key = F.col(key) if isinstance(key, str) else key
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % parts


def module_cache(name: str) -> dict:
    """A dictionary that lives as long as the Python worker, for models that several tasks share."""
    here = sys.modules[__name__]
    caches = here.__dict__.setdefault("_CACHES", {})
    return caches.setdefault(name, {})

MAX_CLASSES = 256


def hashed_sample(df: DataFrame, label: str, by: str, most: int) -> DataFrame:
    """About ``most`` rows of each value of ``label``, chosen by a hash of ``by`` alone, equal rows once.

    Copies of one row hash alike and count once, so a large group of copies adds one row. Labels beyond the
    ``MAX_CLASSES`` most frequent ones are left out; this only fits models, it never limits what is scored.
    """
    known = df.filter(F.col(label).isNotNull() & F.col(by).isNotNull()).select(label, by)
    counts = known.groupBy(label).agg(F.approx_count_distinct(F.xxhash64(by)).alias("_n"))
    found = counts.orderBy(F.desc("_n"), label).limit(MAX_CLASSES).collect()
    if not found:
        return known.limit(0)
    place = F.xxhash64(by) / F.lit(float(2**64)) + F.lit(0.5)
    keep = F.lit(False)
    for value, n in found:
        keep = keep | ((F.col(label) == F.lit(value)) & (place < F.lit(most / max(n, 1))))
    return known.filter(keep).distinct()
