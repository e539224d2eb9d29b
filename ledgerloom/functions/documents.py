"""JSON paths with scalar/fragment rules, XML shredding."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _is_container(doc: Column, path: str) -> Column:
    """True when the node at ``path`` is an object or array, NULL when it is absent."""
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(doc), path, "variant"))
    return kind.startswith("OBJECT") | kind.startswith("ARRAY")


def _may_be_container(found: Column) -> Column:
    return found.startswith("{") | found.startswith("[")


def json_value(doc: Column, path: str) -> Column:
    """Scalar at ``path`` as text; NULL for objects and arrays.

    Only a text that could be an object or array is parsed a second time, to tell it from a
    string scalar that happens to begin with a bracket.
    """
    found = F.get_json_object(doc, path)
    return F.when(_may_be_container(found), F.when(~_is_container(doc, path), found)).otherwise(found)


def json_query(doc: Column, path: str = "$") -> Column:
    """Object or array at ``path`` as JSON text; NULL for scalars."""
    found = F.get_json_object(doc, path)
    return F.when(_may_be_container(found) & _is_container(doc, path), found)


def is_json(doc: Column) -> Column:
    """1 for an object or array, 0 for anything else (also a bare scalar), NULL for NULL."""
    return F.when(doc.isNotNull(), F.coalesce(_is_container(doc, "$"), F.lit(False)).cast("int"))


def each_member(df: DataFrame, doc: str, path: str = "$", key: str = "key", value: str = "value") -> DataFrame:
    """One row per member of the object at ``path``; nested values stay JSON text."""
    members = F.from_json(F.get_json_object(F.col(doc), path), "map<string,string>")
    return df.select(*df.columns, F.explode(members).alias(key, value))


def each_element(df: DataFrame, doc: str, path: str = "$", index: str = "i", value: str = "value") -> DataFrame:
    """One row per element of the array at ``path``, numbered from 0; empty or missing gives none."""
    elements = F.from_json(F.get_json_object(F.col(doc), path), "array<string>")
    return df.select(*df.columns, F.posexplode(elements).alias(index, value))


def typed_object(df: DataFrame, doc: str, fields: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Add typed columns: output name to (type, path)."""
    return df.select(
        *df.columns, *[F.get_json_object(F.col(doc), p).try_cast(kind).alias(name) for name, (kind, p) in fields.items()]
    )


def typed_array(df: DataFrame, doc: str, element: str, path: str = "$") -> DataFrame:
    """One row per object of the array at ``path``, with the columns of the DDL ``element``."""
    rows = F.from_json(F.get_json_object(F.col(doc), path), f"array<struct<{element}>>")
    return df.select(*df.columns, F.inline(rows))


def has_element(doc: Column, element: str, test) -> Column:
    """True when some element of the JSON array passes ``test``: a row is found once, however many match."""
    return F.exists(F.from_json(doc, f"array<{element}>"), test)


def _has_word(text: Column, terms: Sequence[str]) -> Column:
    """True when one of the terms stands alone, with no letter or digit beside it."""
    inside = "|".join(re.escape(t) for t in terms)
    return text.rlike(rf"(?iu)(?<![\p{{L}}\p{{N}}])(?:{inside})(?![\p{{L}}\p{{N}}])")


def contains_terms(text: Column, any_of: Sequence[str] = (), all_of: Sequence[str] = ()) -> Column:
    """Word search with OR and AND lists, ignoring case.

    A text is scanned up to the first hit of each condition; no word list is built.
    """
    cond = F.lit(True)
    for w in all_of:
        cond = cond & _has_word(text, [w])
    if any_of:
        cond = cond & _has_word(text, any_of)
    return cond


def shred_xml(df: DataFrame, doc: str, schema: str) -> DataFrame:
    """Add the columns of the DDL ``schema``, read from the XML element's children."""
    return df.withColumn("__x", F.from_xml(F.col(doc), schema)).select(*df.columns, "__x.*")


def xml_has(doc: Column, schema: str, required: Sequence[str]) -> Column:
    """1 when all required child elements are present, else 0."""
    parsed = F.from_xml(doc, schema)
    cond = F.lit(True)
    for name in required:
        cond = cond & parsed[name].isNotNull()
    return F.coalesce(cond, F.lit(False)).cast("int")
