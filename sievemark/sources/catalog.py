"""Named tables a check may refer to, optionally per site."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from sievemark.sources.sample_views import BASE_TABLES, VIEWS, dependencies

# Site aliases of linked tables, fixed values.
SITE_ALIASES = {
    "edm": "edmtc",
    "fra": "fratc",
    "hou": "houtc_stby",
    "houp": "houtc",
    "nor": "krstc",
    "sha": "shatc",
    "train": "houtrain",
}


class Catalog(Mapping):
    """Mapping of table name to DataFrame; entries may be DataFrames or zero-argument loaders.

    A linked table is named ``table@site``; without a site-specific entry the plain table is used.
    """

    def __init__(self, tables: Mapping[str, DataFrame | Callable[[], DataFrame]], site: str | None = None):
        self._tables = dict(tables)
        self._loaded: dict[str, DataFrame] = {}
        self.site = SITE_ALIASES.get(site, site) if site else None

    def __getitem__(self, name: str) -> DataFrame:
        table, _, site = name.partition("@")
        site = SITE_ALIASES.get(site, site) or self.site
        key = f"{table}@{site}" if site and f"{table}@{site}" in self._tables else table
        if key not in self._loaded:
            entry = self._tables[key]
            self._loaded[key] = entry if isinstance(entry, DataFrame) else entry()
        return self._loaded[key]

    def __iter__(self) -> Iterator[str]:
        return iter(self._tables)

    def __len__(self) -> int:
        return len(self._tables)

    def at(self, site: str) -> "Catalog":
        """The same tables seen from another site."""
        return Catalog(self._tables, site)

    def with_tables(self, **tables: DataFrame) -> "Catalog":
        return Catalog({**self._tables, **tables}, self.site)

    @classmethod
    def from_metastore(cls, spark: SparkSession, names: Mapping[str, str], site: str | None = None) -> "Catalog":
        """Tables by metastore name, e.g. ``{"pitem@edmtc": "edm.pitem"}``; lake, JDBC or parquet tables."""
        return cls({n: (lambda t=t: spark.table(t)) for n, t in names.items()}, site)


_SAMPLES: dict[tuple[str, str], Catalog] = {}


def sample_catalog(spark: SparkSession, sf_dir: str) -> Catalog:
    """All base tables and sample views over one parquet folder."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _SAMPLES:
        tables: dict[str, Callable[[], DataFrame]] = {
            t: (lambda t=t: spark.read.parquet(f"{key[1]}/{t}.parquet")) for t in BASE_TABLES
        }
        catalog = Catalog(tables)
        for view in VIEWS:
            catalog._tables[view] = lambda v=view: spark.sql(VIEWS[v], **{d: catalog[d] for d in dependencies(v)})
        _SAMPLES[key] = catalog
    return _SAMPLES[key]
