"""Child rows folded into JSON arrays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.ordered import ordered_row_number


def children_as_json(
    children: DataFrame, key: str, order: Sequence[str], fields: Sequence[str], page: int, out: str = "items"
) -> DataFrame:
    """Per parent, its children as JSON arrays of at most ``page`` objects, numbered from 0.

    Paging keeps a parent with very many children out of a single task; ``order`` must be
    total, and the pages of a parent in turn hold all its children in order.
    """
    numbered = ordered_row_number(children, [key], order, "__rn")
    paged = numbered.withColumn("page_no", F.floor((F.col("__rn") - 1) / page))
    packed = paged.groupBy(key, "page_no").agg(
        F.sort_array(F.collect_list(F.struct(F.col("__rn"), F.struct(*fields).alias("o")))).alias("__l")
    )
    return packed.select(key, "page_no", F.to_json(F.transform("__l", lambda x: x["o"])).alias(out))
