"""One query over many sites, merged into one table."""

from __future__ import annotations

import re
import threading
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from sievemark.operators.sets import union_distinct
from sievemark.session import checkpoint_folder

# The sites of a full extract, in order, and all known sites.
ALL_SITES = ("edm", "fra", "houstby", "nor", "sha")
KNOWN_SITES = ("edm", "fra", "houstby", "houprod", "nor", "sha", "dw", "ds")
# Site -> (text of the error, site to ask instead).
FALLBACK = {"houstby": ("read-only", "houprod")}

_CODE = r"\b[A-Z]{3}-(\d{4,5})\b"
STATUS_SCHEMA = "position int, site string, status string, attempts int, message string"


@dataclass
class Extract:
    df: DataFrame
    status: DataFrame


class ExtractFailed(RuntimeError):
    """No site answered, or a site failed in strict mode."""


def error_code(error: Exception) -> int | None:
    """Number of a database error: the ``code`` attribute, or the digits of an ``ABC-01234`` text."""
    code = getattr(error, "code", None)
    if isinstance(code, int):
        return code
    found = re.search(_CODE, str(error))
    return int(found.group(1)) if found else None


def _told(error: Exception) -> str:
    """The line of an error that names its code, else the first one."""
    lines = [x.strip() for x in str(error).split("\n") if x.strip()] or [type(error).__name__]
    return next((x for x in lines if re.search(_CODE, x)), lines[0])


class _Sites:
    """Sites still to be asked, and what happened at each, shared by the threads that ask them."""

    def __init__(self, readers, retry, retry_delay, retry_on, fallback):
        self.readers, self.budget, self.delay, self.retry_on, self.fallback = readers, retry, retry_delay, set(retry_on), fallback
        self.lock = threading.Lock()
        self.status: dict[str, tuple[str, int, str | None]] = {}
        self.frames: dict[str, DataFrame] = {}
        self.stands_in: dict[str, str] = {}

    def _failed(self, site: str, error: Exception) -> list[str]:
        """Records a failure; gives the site again if it may be retried, or the one to ask instead."""
        text = _told(error)
        with self.lock:
            self.status[site] = ("failed", self.status[site][1], text)
            if error_code(error) in self.retry_on:
                if self.budget < 1:
                    return []
                self.budget -= 1
            elif site in self.fallback and self.fallback[site][0] in str(error):
                other = self.fallback[site][1]
                self.stands_in[other] = site
                return [other]
            else:
                return []
        time.sleep(self.delay)
        return [site]

    def ask(self, site: str, read: Callable[[str, DataFrame], DataFrame]) -> None:
        """Asks a site, and on failure itself again or its stand-in, until one answers or nothing is left to try."""
        todo = [site]
        while todo:
            site = todo.pop()
            with self.lock:
                self.status[site] = ("asked", self.status.get(site, ("", 0, None))[1] + 1, None)
            if site not in self.readers:
                self.status[site] = ("invalid", self.status[site][1], f"{site} not valid")
                continue
            try:
                frame = read(site, self.readers[site]())
            except Exception as e:  # noqa: BLE001 - a failing site must not stop the others
                todo = self._failed(site, e)
                continue
            with self.lock:
                self.frames[site] = frame
                self.status[site] = ("ok", self.status[site][1], None)
                if site in self.stands_in:
                    first = self.stands_in[site]
                    self.status[first] = ("replaced", *self.status[first][1:])


def extract(
    spark: SparkSession,
    readers: Mapping[str, Callable[[], DataFrame]],
    sites: str | Sequence[str] = "all",
    *,
    retry: int = 0,
    retry_delay: float = 0,
    retry_on: Sequence[int] = (),
    fallback: Mapping[str, tuple[str, str]] = FALLBACK,
    strict: bool = False,
    folder: str | None = None,
    parallel: int = 5,
) -> Extract:
    """Union of the rows of all sites, equal rows once, and what happened at each site.

    Every site is read to its end into a part of its own below ``folder`` (the shared checkpoint folder if none is
    named), several sites at a time. A site that fails, when it is opened or in the middle of its rows, leaves
    nothing behind and is skipped; errors in ``retry_on`` are tried again from one budget that all sites share. A
    site whose fallback has answered is ``replaced``, which is no failure.
    """
    names = list(ALL_SITES) if sites == "all" else [sites] if isinstance(sites, str) else list(sites)
    folder = folder or f"{checkpoint_folder(spark)}/extract-{uuid.uuid4().hex}"
    asked = _Sites(readers, retry, retry_delay, retry_on, fallback)

    def read(site: str, frame: DataFrame) -> DataFrame:
        path = f"{folder}/{site}"
        frame.write.mode("overwrite").parquet(path)
        return spark.read.schema(frame.schema).parquet(path)

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        list(pool.map(lambda s: asked.ask(s, read), names))
    # In the order of the list, each site followed by the one that was asked instead.
    order = [s for n in names for s in (n, *[other for other, first in asked.stands_in.items() if first == n])]
    status = {s: asked.status[s] for s in dict.fromkeys(order)}
    failed = [s for s, (state, _, _) in status.items() if state not in ("ok", "replaced")]
    if not asked.frames or (strict and failed):
        raise ExtractFailed(f"no data from {', '.join(failed) or 'any site'}")
    rows = [(i, s, *v) for i, (s, v) in enumerate(status.items(), start=1)]
    return Extract(union_distinct([asked.frames[s] for s in status if s in asked.frames]), spark.createDataFrame(rows, STATUS_SCHEMA))


def jdbc_readers(spark: SparkSession, urls: Mapping[str, str], query: str, **options: str) -> dict[str, Callable[[], DataFrame]]:
    """Readers that run the same query at each site's database; filters and columns are pushed down."""
    return {s: (lambda u=u: spark.read.format("jdbc").option("url", u).option("query", query).options(**options).load()) for s, u in urls.items()}
