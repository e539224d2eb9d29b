"""Masking, row-level access and column encryption, with the caller's role as an argument."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def mask_default(column: Column, kind: T.DataType) -> Column:
    """Text to ``xxxx``, numbers to 0, dates to 1900-01-01; NULL stays NULL."""
    if isinstance(kind, T.StringType):
        blank = F.lit("xxxx")
    elif isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        blank = F.lit("1900-01-01").cast(kind)
    elif isinstance(kind, T.NumericType):
        blank = F.lit(0).cast(kind)
    else:
        blank = F.lit(None).cast(kind)
    return F.when(column.isNotNull(), blank)


def mask_email(column: Column) -> Column:
    """First letter kept, the rest fixed: ``aXXX@XXXX.com``."""
    return F.concat(F.left(column, F.lit(1)), F.lit("XXX@XXXX.com"))


def mask_partial(column: Column, prefix: int, padding: str, suffix: int) -> Column:
    """Keep ``prefix`` and ``suffix`` characters around ``padding``; a text too short for both gets padding only."""
    kept = F.concat(F.left(column, F.lit(prefix)), F.lit(padding), F.right(column, F.lit(suffix)))
    return F.when(column.isNull(), F.lit(None)).when(F.length(column) > prefix + suffix, kept).otherwise(F.lit(padding))


def masked_view(df: DataFrame, policy: Mapping[str, Callable[[Column, T.DataType], Column]], unmask: bool) -> DataFrame:
    """Apply the policy unless the reader may see plain values.

    Written copies of the result stay masked, because the masking is in the data.
    """
    if unmask:
        return df
    return df.select(
        *[policy[f.name](F.col(f.name), f.dataType).alias(f.name) if f.name in policy else F.col(f.name) for f in df.schema.fields]
    )


def visible_rows(df: DataFrame, grants: DataFrame, user: str | None, key: str, manager: bool = False) -> DataFrame:
    """Rows whose ``key`` is granted to ``user``; managers see all, no user sees none.

    ``grants``: user_name, granted_key.
    """
    if manager:
        return df
    if user is None:
        return df.filter(F.lit(False))
    mine = grants.filter(F.col("user_name") == F.lit(user)).select("granted_key").distinct()
    return df.join(mine, df[key] == mine["granted_key"], "left_semi")


def split_writes(candidates: DataFrame, grants: DataFrame, user: str, key: str) -> DataFrame:
    """Mark rows a user wants to write as ``allowed`` or not (key outside the user's grants, or NULL)."""
    mine = grants.filter(F.col("user_name") == F.lit(user)).select("granted_key").distinct()
    return candidates.join(mine, candidates[key] == mine["granted_key"], "left").select(
        *[candidates[c] for c in candidates.columns], mine["granted_key"].isNotNull().alias("allowed")
    )


def encrypt(df: DataFrame, columns: Sequence[str], key: Column) -> DataFrame:
    """AES-GCM with a random nonce, as base64 text."""
    return df.withColumns({c: F.base64(F.aes_encrypt(F.col(c).cast("string").cast("binary"), key)) for c in columns})


def decrypt(df: DataFrame, columns: Sequence[str], key: Column) -> DataFrame:
    return df.withColumns({c: F.aes_decrypt(F.unbase64(F.col(c)), key).cast("string") for c in columns})
