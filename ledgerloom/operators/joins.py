"""Join helpers beyond ``DataFrame.join``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_safe_on(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    """Join condition under which NULL equals NULL."""
    cond = None
    for a, b in pairs:
        c = left[a].eqNullSafe(right[b])
        cond = c if cond is None else cond & c
    return cond


def full_outer(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Full outer equi-join as left join plus unmatched right rows.

    Adaptive execution can split a hot key in a left or anti join, but not in a full join.
    """
    cond = left[left_key] == right[right_key]
    matched = left.join(right, cond, "left")
    lonely = right.join(left.select(left_key).distinct(), cond, "left_anti")
    blanks = [F.lit(None).cast(f.dataType).alias(f.name) for f in left.schema.fields]
    return matched.union(lonely.select(*blanks, *right.columns))


def one_row_per_key(dim: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the row with the smallest ``order`` per key, by partial aggregation."""
    rest = [c for c in dim.columns if c not in keys]
    ordered = [*order, *[c for c in rest if c not in order]]
    best = dim.groupBy(*keys).agg(F.min(F.struct(*ordered)).alias("__best"))
    return best.select(*[F.col(c) if c in keys else F.col(f"__best.{c}").alias(c) for c in dim.columns])


def require_unique(dim: DataFrame, keys: Sequence[str], what: str = "lookup") -> DataFrame:
    """Pass ``dim`` through, failing the job when a key occurs twice.

    The check is part of the plan, not an extra action: the keys alone are counted (a hash
    aggregate that combines before the shuffle), and the number of repeated ones, a scalar
    subquery, stands in a filter on the rows.
    """
    counts = dim.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    repeated = counts.filter("__n > 1").agg(F.count(F.lit(1))).scalar()
    failure = F.raise_error(F.lit(f"{what}: key {list(keys)} is not unique")).cast("boolean")
    return dim.filter(F.when(repeated > 0, failure).otherwise(F.lit(True)))


def lookup_equi(
    df: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    cols: Mapping[str, str],
    constants: Mapping[str, object] | None = None,
) -> DataFrame:
    """Left lookup: ``on`` maps df column to dim column, ``cols`` dim column to output name."""
    for name, value in (constants or {}).items():
        dim = dim.filter(F.col(name) == F.lit(value))
    keyed = dim.select(*[F.col(b).alias(f"__k_{b}") for b in on.values()], *[F.col(c).alias(o) for c, o in cols.items()])
    keyed = require_unique(keyed, [f"__k_{b}" for b in on.values()])
    cond = None
    for a, b in on.items():
        c = F.col(a) == F.col(f"__k_{b}")
        cond = c if cond is None else cond & c
    return df.join(keyed, cond, "left").drop(*[f"__k_{b}" for b in on.values()])


def lookup_by_either(
    df: DataFrame, alias_dim: DataFrame, first: str, second: str, alias: str, result: str, out: str
) -> DataFrame:
    """Look ``alias`` up by ``first`` and, failing that, by ``second``: two equi joins.

    An ``a = k OR b = k`` condition would force a nested loop and could return two rows.
    """
    one = require_unique(alias_dim.select(F.col(alias).alias("__a1"), F.col(result).alias("__r1")), ["__a1"])
    two = require_unique(alias_dim.select(F.col(alias).alias("__a2"), F.col(result).alias("__r2")), ["__a2"])
    return (
        df.join(one, F.col(first) == F.col("__a1"), "left")
        .join(two, F.col(second) == F.col("__a2"), "left")
        .withColumn(out, F.coalesce("__r1", "__r2")).drop("__a1", "__r1", "__a2", "__r2")
    )


def by_id_list(df: DataFrame, column: str, ids_json: str, element: str = "bigint") -> DataFrame:
    """Rows whose ``column`` is in a JSON array of ids; repeated ids do not repeat rows."""
    spark = df.sparkSession
    ids = spark.range(1).select(F.explode(F.from_json(F.lit(ids_json), f"array<{element}>")).alias("__id")).distinct()
    return df.join(ids, df[column] == ids["__id"], "left_semi")
