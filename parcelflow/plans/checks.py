"""Expectations of a load, on figures that are gathered in the very pass that writes it.

The figures are aggregates that Spark observes as rows go by, so no second scan is made. A load that fails stays where it
was written and is not committed; warnings are only told.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.expressions import clean_guid
from ..schemas import MAY_BE_EMPTY


class LoadRefused(Exception):
    """A load that does not meet what is expected of it; .seen holds the figures."""

    def __init__(self, reason: str, seen: dict[str, object]):
        super().__init__(reason)
        self.seen = seen


@dataclass(frozen=True)
class Check:
    """An aggregate over the rows of a load and what its value must be; `fails` says whether the load is refused or only
    warned of. Parts in `exempt` may miss it."""

    name: str
    figure: Column
    meets: Callable[[object], bool]
    reason: str
    fails: bool = True
    exempt: tuple[str, ...] = ()


def not_empty(fails: bool = True) -> Check:
    """Rows are expected, but for provinces that may have none."""
    return Check("n_rows", F.count(F.lit(1)), lambda n: n > 0, "no rows", fails, tuple(MAY_BE_EMPTY))


def some_sales() -> Check:
    """A load without sales is told, not refused."""
    return Check("n_sales", F.count("soldPrice"), lambda n: n > 0, "no sales", False, tuple(MAY_BE_EMPTY))


def known_areas(most: float = 0.5) -> Check:
    """At most this share of the rows may lack area ids; without rows there is nothing to lack."""
    share = F.coalesce(F.try_divide(F.count_if(clean_guid().isNull()), F.count(F.lit(1))), F.lit(0.0))
    return Check("share_without_area", share, lambda x: x <= most, "too many rows without an area")


def all_named(key: str = "_id") -> Check:
    return Check("n_without_key", F.count_if(F.col(key).isNull()), lambda n: n == 0, "rows without a key")


def loaded_enough(least: float = 0.5, ok: str = "loaded") -> Check:
    """At least this share of the attempted rows were loaded; no attempts are a warning of not_empty(), not a failure here."""
    share = F.coalesce(F.try_divide(F.count_if(ok), F.count(F.lit(1))), F.lit(1.0))
    return Check("share_loaded", share, lambda x: x >= least, "too few rows loaded")


def checked_write(df: DataFrame, path: str, part: str, checks: list[Check]) -> dict[str, object]:
    """Write df as Parquet and return what the checks saw; LoadRefused if one that counts is not met. The caller commits the
    folder or leaves it."""
    if not checks:
        df.write.parquet(path)
        return {}
    observed = Observation(f"load of {part}")
    df.observe(observed, *(c.figure.alias(c.name) for c in checks)).write.parquet(path)
    seen = observed.get
    for c in checks:
        if part not in c.exempt and not c.meets(seen[c.name]):
            if c.fails:
                raise LoadRefused(f"{part}: {c.reason} ({c.name} = {seen[c.name]})", seen)
            warnings.warn(f"{part}: {c.reason} ({c.name} = {seen[c.name]})", stacklevel=2)
    return seen
