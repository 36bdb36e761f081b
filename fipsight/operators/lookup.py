"""Dimension lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fips_lookup(df: DataFrame, lookup: DataFrame, name: str, state: str | None,
                lk_fips: str = "fips", lk_name: str = "name", lk_state: str = "state",
                suffix: str = " County", min_fips: int = 1000, out: str = "fips",
                on_name_only: bool = False, order_col: str | None = None) -> DataFrame:
    """County key by name: ``name + suffix`` (and state) looked up in a FIPS table.

    Lookup rows with ``fips <= min_fips`` (state-level rows) are dropped. By default the key is
    (name, state), since one county name occurs in many states. ``on_name_only=True`` keys by
    name alone. A key that occurs in several rows takes the last one by ``order_col`` (rows of a
    table have no order of their own; without the column the largest FIPS code wins), so the lookup
    never multiplies rows. Unknown names give NULL (left join) instead of failing the job.
    """
    lk = lookup.where(F.col(lk_fips) > min_fips)
    keys = [lk_name] if on_name_only else [lk_name, lk_state]
    order = F.struct(F.col(order_col or lk_fips), F.col(lk_fips))
    lk = lk.groupBy(*[F.col(c).alias("_lk_" + c) for c in keys]).agg(F.max_by(lk_fips, order).alias(out))
    cond = F.concat(F.col(name), F.lit(suffix)) == F.col("_lk_" + lk_name)
    if not on_name_only:
        cond = cond & (F.col(state) == F.col("_lk_" + lk_state))
    j = df.join(lk, cond, "left")
    return j.drop(*["_lk_" + c for c in keys])
