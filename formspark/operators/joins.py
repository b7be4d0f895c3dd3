"""Join helpers: validated many-to-one left join and null-safe multi-way align."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join_m1(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Left equi-join that fails when a key occurs more than once on the right.

    The right side is reduced per key (count + first of the other columns);
    the join key is wrapped in a check that raises for a duplicated key, so the
    validation runs inside the same job as the join.  Rows with a null key
    never match (plain equality), as in an ordinary left join.
    """
    others = [c for c in right.columns if c not in on]
    r = right.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(c) for c in others])
    checked = r.select(
        *[F.when(F.col("_n") > 1, F.raise_error(F.lit(f"join keys {on} are not unique on the right side")))
          .otherwise(F.col(k)).alias(k) for k in on],
        *others,
    )
    return left.join(checked, on, "left")


def align(frames: list[DataFrame], on: list[str]) -> DataFrame:
    """Full outer join of several frames on shared key columns, null keys matching.

    Keys are coalesced from both sides; the remaining columns of each frame
    are kept (names must not clash).  For the wide table this whole operator
    is replaced by one grouped aggregation.
    """
    if not frames:
        raise ValueError("nothing to align")

    def step(a: DataFrame, b: DataFrame) -> DataFrame:
        cond = reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[k]) for k in on])
        keys = [F.coalesce(a[k], b[k]).alias(k) for k in on]
        rest = [a[c] for c in a.columns if c not in on] + [b[c] for c in b.columns if c not in on]
        return a.join(b, cond, "full").select(*keys, *rest)

    return reduce(step, frames)
