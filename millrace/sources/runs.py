"""Runs of the scans: their parameters, and the choice of a scan by the name of its source."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import mappings as M
from ..functions import text as T


@dataclass(frozen=True)
class Run:
    source: str = "moet"
    years: list[int] = field(default_factory=lambda: list(M.DEFAULT_YEARS))
    codes: list[str] | None = None


def parse(source: str = "moet", years: str = "", codes: str = "") -> Run:
    """A run from its parameters as text: the source in lower case, years and codes as comma-separated lists; no years are the default
    ones, no codes are all."""
    picked = sorted({c.strip().upper() for c in codes.split(",")}) if codes else None
    return Run(source.strip().lower(), [int(y) for y in years.split(",")] if years else list(M.DEFAULT_YEARS), picked)


def columns(source, years, codes) -> dict[str, Column]:
    """The same for a table of runs: source, scan, years and codes as columns."""
    name = T.strip(F.lower(source))
    y = F.transform(F.split(F.coalesce(F.col(years), F.lit("")), ","), T.to_int)
    c = F.array_sort(F.array_distinct(F.transform(F.split(F.coalesce(F.col(codes), F.lit("")), ","), lambda x: F.upper(T.strip(x)))))
    return {
        "source": name, "scan": scan_of(name), "years": F.when(F.coalesce(F.col(years), F.lit("")) == "", F.array(*[F.lit(k).cast("bigint") for k in M.DEFAULT_YEARS])).otherwise(y),
        "codes": F.when(F.coalesce(F.col(codes), F.lit("")) != "", c),
    }


def scan_of(source: Column) -> Column:
    return F.when(source.isin(M.SOURCES), source).otherwise(F.lit("sites"))


def dispatch(run: Run, scans: dict[str, Callable[[Run], DataFrame]]) -> DataFrame:
    """The scan that the source names; a name without a scan of its own is given to `sites`."""
    return scans.get(run.source, scans["sites"])(run)
