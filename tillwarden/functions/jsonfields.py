"""Typed access to JSON objects with the node type kept.

``from_json`` would read the number 1 as a string and lose a quoted number. So each declared field is
read as VARIANT in one pass over the text, and its node type is looked at before a value is taken.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import not_blank

_BAD = "_bad"


def parse(text: Column, fields: Sequence[str]) -> Column:
    """Struct of the fields as VARIANT; text that is not an object is kept in ``_bad``."""
    schema = ", ".join(f"`{f}` variant" for f in fields) + f", {_BAD} string"
    return F.from_json(text, schema, {"columnNameOfCorruptRecord": _BAD})


def is_object(doc: Column) -> Column:
    return doc.isNotNull() & doc[_BAD].isNull()


def is_not_json(doc: Column) -> Column:
    """True for text that is no JSON at all; scalars and arrays are JSON. Tried for rejects only."""
    return F.when(doc[_BAD].isNotNull(), F.try_parse_json(doc[_BAD]).isNull()).otherwise(F.lit(False))


def kind(doc: Column, field: str) -> Column:
    """Type name of a field's node: NULL when missing, ``VOID`` for JSON null."""
    return F.schema_of_variant(doc[field])


def present(doc: Column, field: str) -> Column:
    return F.coalesce(kind(doc, field) != "VOID", F.lit(False))


def value(doc: Column, field: str, type_name: str) -> Column:
    """The field in another type; NULL when missing, JSON null or not convertible."""
    return F.try_variant_get(doc[field], "$", type_name)


def text_name(field: str) -> str:
    return f"_t_{field}"


def with_document(df: DataFrame, source: str, doc: str, fields: Sequence[str] = (), texts: Sequence[str] = ()) -> DataFrame:
    """Adds the parsed document and ``_t_<field>`` for each of ``texts``: the JSON string that is not
    blank, else NULL. ``fields`` are read as well, but only as VARIANT.

    The values pass through a one-element ``explode``. Filters are not pushed below a generator, so a
    filter on a parsed field does not repeat the parsing, and the generated code stays small.
    """
    parsed = df.withColumn(doc, parse(F.col(source), [*texts, *fields]))
    d = F.col(doc)
    found = [F.when(kind(d, f) == "STRING", value(d, f, "string")).alias(f) for f in texts]
    once = parsed.withColumn("_once", F.explode(F.array(F.struct(d.alias("_doc"), *found))))
    columns = {doc: F.col("_once._doc"), **{text_name(f): F.col(f"_once.{f}") for f in texts}}
    flat = once.withColumns(columns).drop("_once")
    return flat.withColumns({text_name(f): not_blank(text_name(f)) for f in texts}) if texts else flat


def is_number(doc: Column, field: str) -> Column:
    return F.coalesce(kind(doc, field).rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)"), F.lit(False))


def is_integer(doc: Column, field: str) -> Column:
    """A number written without a fraction (or with a zero one)."""
    as_double = value(doc, field, "double")
    return is_number(doc, field) & F.coalesce(as_double == F.floor(as_double), F.lit(False))


def number(doc: Column, field: str, type_name: str = "double") -> Column:
    """Value only when the node is a JSON number."""
    return F.when(is_number(doc, field), value(doc, field, type_name))


def coerced_double(doc: Column, field: str) -> Column:
    """Number of any present node: numeric text converts, whatever does not convert is 0."""
    return F.when(present(doc, field), F.coalesce(value(doc, field, "double"), F.lit(0.0)))


def coerced_money(doc: Column, field: str, type_name: str) -> Column:
    """Exact decimal of a JSON number or of a JSON string holding a number; else NULL."""
    as_text = F.trim(value(doc, field, "string"))
    return F.when(kind(doc, field).rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL|STRING)"), as_text.try_cast(type_name))


def text_items(doc: Column, field: str) -> Column:
    """Array of the string elements of a JSON array; other elements are left out."""
    texts = F.transform(
        F.filter(value(doc, field, "array<variant>"), lambda v: F.schema_of_variant(v) == "STRING"),
        lambda v: F.try_variant_get(v, "$", "string"),
    )
    return F.coalesce(texts, F.array().cast("array<string>"))


def json_or_null(text: Column) -> Column:
    """Text as a JSON value; NULL stays NULL and does not become a JSON null."""
    return F.when(text.isNotNull(), F.parse_json(text))
