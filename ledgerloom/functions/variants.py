"""JSON documents parsed once: a VARIANT column is made at load and stored, and every path reads from it.

The functions of ``documents`` read JSON text and parse it for each path, which is right for one path of a text that comes by
once. Here the text is parsed when it is loaded; a path then walks the binary form.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parsed(df: DataFrame, doc: str, out: str) -> DataFrame:
    """``df`` with the text column ``doc`` as a VARIANT ``out``; NULL for NULL and for text that is no JSON."""
    return df.withColumn(out, F.try_parse_json(F.col(doc)))


def malformed(df: DataFrame, doc: str, out: str) -> DataFrame:
    """Rows of ``parsed`` whose text is no JSON, for a reject channel."""
    return df.filter(F.col(doc).isNotNull() & F.col(out).isNull())


def stored(df: DataFrame, doc: str, out: str, path: str) -> DataFrame:
    """Write the documents parsed, without their text, and read them back."""
    made = parsed(df, doc, out).drop(doc)
    made.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(made.schema).parquet(path)


def _contains(doc: Column, path: str) -> Column:
    kind = F.schema_of_variant(F.try_variant_get(doc, path, "variant"))
    return kind.startswith("OBJECT") | kind.startswith("ARRAY")


def value_at(doc: Column, path: str) -> Column:
    """Scalar at ``path`` as text; NULL for objects, arrays, JSON nulls and nothing there."""
    found = F.try_variant_get(doc, path, "string")
    # Only a text that looks like a container needs a look at its kind.
    return F.when(found.startswith("{") | found.startswith("["), F.when(~_contains(doc, path), found)).otherwise(found)


def fragment_at(doc: Column, path: str = "$") -> Column:
    """Object or array at ``path`` as JSON text, members in the order of their names; NULL for scalars."""
    return F.when(_contains(doc, path), F.to_json(F.try_variant_get(doc, path, "variant")))


def typed_at(df: DataFrame, doc: str, fields: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Add typed columns: output name to (type, path); a value of another type gives NULL."""
    return df.withColumns({name: F.try_variant_get(F.col(doc), path, kind) for name, (kind, path) in fields.items()})


def elements_of(df: DataFrame, doc: str, path: str = "$", index: str = "i", value: str = "value") -> DataFrame:
    """One row per element of the array at ``path``, numbered from 0, as VARIANT; anything else gives none."""
    elements = F.try_variant_get(F.col(doc), path, "array<variant>")
    return df.select(*df.columns, F.posexplode(elements).alias(index, value))


def members_of(df: DataFrame, doc: str, path: str = "$", key: str = "key", value: str = "value") -> DataFrame:
    """One row per member of the object at ``path``, its value as VARIANT; anything else gives none."""
    members = F.try_variant_get(F.col(doc), path, "map<string,variant>")
    return df.select(*df.columns, F.explode(members).alias(key, value))
