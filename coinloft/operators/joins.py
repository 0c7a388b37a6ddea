"""Join patterns. No broadcast hints: small sides are picked by measured size."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def left_join_preagg(base: DataFrame, key: str, branches: Sequence[tuple[DataFrame, Mapping]]) -> DataFrame:
    """Left join frames that hold one row per key, then fill their gaps.

    Each branch is already grouped by ``key``, so every join is one-to-one at
    most and all of them share the partitioning by ``key``.
    """
    out = base
    for frame, defaults in branches:
        out = out.join(frame, key, "left")
        for name, value in defaults.items():
            filler = value if isinstance(value, Column) else F.lit(value)
            out = out.withColumn(name, F.coalesce(F.col(name), filler))
    return out


def left_join_on_filter(left: DataFrame, right: DataFrame, on: str | Sequence[str], right_condition: Column) -> DataFrame:
    """The extra predicate limits the right side only: unmatched left rows stay.

    An outer join cannot split a hot key of its right side, an inner join can.
    So matches come from an inner join and the other left rows from an anti
    join against the distinct right keys.
    """
    keys = [on] if isinstance(on, str) else list(on)
    kept = right.where(right_condition)
    matched = left.join(kept, keys)
    lone = left.join(kept.select(*keys).distinct(), keys, "left_anti")
    return matched.unionByName(lone, allowMissingColumns=True)


def chain_join(df: DataFrame, steps: Sequence[tuple[DataFrame, str | Sequence[str], str]]) -> DataFrame:
    for other, on, how in steps:
        df = df.join(other, on, how)
    return df


def orphan_check(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose key is set but has no parent."""
    parents = parent.select(F.col(pk).alias(fk)).distinct()
    return child.where(F.col(fk).isNotNull()).join(parents, fk, "left_anti")


def match_counts(df: DataFrame, key: str, **aggregates: Column) -> DataFrame:
    """Per key: ``n`` rows plus the given aggregates, summed on the map side first."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"), *[
        c.alias(name) for name, c in aggregates.items()
    ])


def at_least_one(n: str | Column) -> Column:
    """Rows a left join emits for a key with ``n`` matches (none still gives one)."""
    return F.greatest(F.coalesce(F.col(n) if isinstance(n, str) else n, F.lit(0)), F.lit(1))


def one_row(df: DataFrame) -> Column:
    """The single row of an aggregate as a struct column (a scalar subquery, no join)."""
    return df.select(F.struct("*").alias("row")).scalar()
