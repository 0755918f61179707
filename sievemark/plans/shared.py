"""Tables of one run that many checks read, stored once: master paths cut to the staged ids, and derived tables."""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemark.operators import paths as K
from sievemark.plans.check import SHARED_IDS, Check, Context
from sievemark.session import checkpoint_folder, plan_nodes, shuffles_removed
from sievemark.sources import sinks


class _Added(Mapping):
    """The tables of a run with a few more."""

    def __init__(self, refs: Mapping[str, DataFrame], more: Mapping[str, DataFrame]):
        self.refs, self.more = refs, dict(more)

    def __getitem__(self, name: str) -> DataFrame:
        return self.more[name] if name in self.more else self.refs[name]

    def __iter__(self):
        yield from self.more
        yield from (n for n in self.refs if n not in self.more)

    def __len__(self) -> int:
        return len(set(self.refs) | set(self.more))


class _Counted(Mapping):
    """The tables of a run, counting how often each is read."""

    def __init__(self, refs: Mapping[str, DataFrame]):
        self.refs, self.reads = refs, Counter()

    def __getitem__(self, name: str) -> DataFrame:
        self.reads[name] += 1
        return self.refs[name]

    def __contains__(self, name: object) -> bool:
        return name in self.refs

    def __iter__(self):
        return iter(self.refs)

    def __len__(self) -> int:
        return len(self.refs)


def _reads(ctx: Context, checks: Sequence[Check]) -> Counter:
    """How often the checks read each master table."""
    refs = _Counted(ctx.refs)
    counted = replace(ctx, refs=refs)
    for check in checks:
        try:
            check.make(counted)
        except Exception:  # noqa: BLE001 - reported when the check runs
            continue
    return refs.reads


def _is_derived(df: DataFrame) -> bool:
    """Whether rows of stored tables are joined, grouped or ranked to get the table."""
    nodes = set(plan_nodes(df))
    return "Relation" in nodes and bool(nodes & {"Join", "Aggregate", "Window", "Distinct"}) and all(t != "void" for _, t in df.dtypes)


def _is_stored(df: DataFrame) -> bool:
    """Whether the rows are read from one table by row-wise steps."""
    nodes = plan_nodes(df)
    return nodes.count("Relation") == 1 and set(nodes) <= {"Relation", "Project", "Filter"}


def share_paths(ctx: Context, checks: Sequence[Check] = ()) -> tuple[Context, list[str]]:
    with shuffles_removed(ctx.chk.sparkSession):
        return _share_paths(ctx, checks)


def _share_paths(ctx: Context, checks: Sequence[Check]) -> tuple[Context, list[str]]:
    """The context with shared paths, and the names of the tables behind them.

    The set of staged ids, and the rows of the warehouse master and of the items that these ids name are written once,
    bucketed by id, so their joins need no shuffle; so are the staged rows, unless they are a stored table already.
    Only paths that checks look up by a staged id are cut; the master tables themselves stay whole. Without id
    columns there are no such paths.

    Staged rows, and master tables that ``checks`` read more than once, are written once as they are, where joins or
    groups are needed to get them: the plan of a check would work them out again for every use.
    """
    spark = ctx.chk.sparkSession
    run, folder, names = uuid.uuid4().hex[:12], f"{checkpoint_folder(spark)}/shared", []
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def stored(df: DataFrame, name: str, key: str) -> DataFrame:
        table = f"{name}_{run}"
        sinks.write_bucketed(df, table, key, buckets, f"{folder}/{table}")
        names.append(table)
        return spark.table(table)

    def kept(name: str) -> DataFrame | None:
        try:
            df = ctx.refs[name]
            if not _is_derived(df):
                return None
            df.write.parquet(f"{folder}/{name}_{run}")
        except Exception:  # noqa: BLE001 - the checks that read the table find out
            return None
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}_{run}")

    if checks:
        wanted = sorted(n for n, k in _reads(ctx, checks).items() if k > 1)
        names += [f"{n}_{run}" for n in wanted]
        with ThreadPoolExecutor(max_workers=4) as pool:
            found = dict(zip(wanted, pool.map(kept, wanted)))
        ctx = replace(ctx, refs=_Added(ctx.refs, {n: df for n, df in found.items() if df is not None}))
    if not ctx.id_columns:
        if checks and _is_derived(ctx.chk):
            name = f"shared_staged_{run}"
            names.append(name)
            ctx.chk.write.parquet(f"{folder}/{name}")
            ctx = replace(ctx, chk=spark.read.schema(ctx.chk.schema).parquet(f"{folder}/{name}"))
        return ctx, names
    if not _is_stored(ctx.chk):
        ctx = replace(ctx, chk=stored(ctx.chk, "shared_staged", ctx.id_columns[0]))
    ids = stored(ctx.ids, SHARED_IDS, "tc_id")
    staged = ids.filter(F.col("tc_id").isNotNull())
    more = {SHARED_IDS: ids}
    if "item_all_site" in ctx.refs:
        more[K.SHARED_MASTER] = stored(K.only(K.master(ctx.refs, ""), "key", staged), K.SHARED_MASTER, "key")
    if "pitem" in ctx.refs and "ppom_object" in ctx.refs:
        more[K.SHARED_ITEMS] = stored(K.only(K.items_with_site(ctx.refs), "item_key", staged), K.SHARED_ITEMS, "item_key")
    return replace(ctx, refs=_Added(ctx.refs, more)), names


def drop_shared(ctx: Context, names: list[str]) -> None:
    """Tables and files of a run that is over."""
    spark = ctx.chk.sparkSession
    for name in names:
        spark.sql(f"drop table if exists {name}")
        sinks.remove(spark, f"{checkpoint_folder(spark)}/shared/{name}")
