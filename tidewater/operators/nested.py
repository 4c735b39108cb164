"""JSON texts without a fixed schema, as variants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.sources.durable import discard, durable


def variant_fields(doc: Column, fields: dict[str, tuple[str, str]]) -> list[Column]:
    """Columns name = (path, type) of a variant; null where the path is absent or the value cannot be cast."""
    return [F.try_variant_get(doc, path, kind).alias(name) for name, (path, kind) in fields.items()]


def open_items(df: DataFrame, text: str, items: str, head: dict[str, tuple[str, str]], fields: dict[str, tuple[str, str]]) -> DataFrame:
    """One row per element of the array at path ``items``: the other columns, ``is_broken``, ``head`` of the text and ``fields`` of the element.

    Fields may be absent, null or of another type in some rows. A text that is null, broken, or has no array (or an
    empty one) gives one row without element; ``is_broken`` is true for texts that are no JSON.
    """
    own = [F.col(f"`{c}`") for c in df.columns if c != text]
    parsed = df.select(*own, F.col(text).alias("_text"), F.try_parse_json(text).alias("_doc"))
    rows = parsed.select(*own, (F.col("_text").isNotNull() & F.col("_doc").isNull()).alias("is_broken"), *variant_fields(F.col("_doc"), head),
                         F.explode_outer(F.try_variant_get("_doc", items, "array<variant>")).alias("_item"))
    return rows.select("*", *variant_fields(F.col("_item"), fields)).drop("_item")


def _kind(value: Column) -> Column:
    """Type of a variant: object, array, string, boolean, null or number."""
    name = F.schema_of_variant(value)
    return (F.when(name.startswith("OBJECT"), "object").when(name.startswith("ARRAY"), "array").when(name == "STRING", "string")
            .when(name == "BOOLEAN", "boolean").when(name == "VOID", "null").otherwise("number"))


def field_inventory(df: DataFrame, text: str, depth: int | None = None) -> DataFrame:
    """(field, type, n): how often every path of the JSON texts occurs with every type.

    Members of objects are named ``a.b``, elements of arrays ``a[]``. Level by level the values are opened and counted, until none
    is an object or an array (or ``depth`` levels are done); only counts are kept of a level. Null and broken texts are ignored;
    of a member that an object names twice the last one counts.
    """
    level = durable(df.select(F.lit("").alias("field"), F.try_parse_json(text).alias("v")).filter("v is not null").withColumn("type", _kind(F.col("v"))), "level")
    counts, done = [], 0
    while not (nested := level.filter("type in ('object', 'array')")).isEmpty() and done != depth:
        prefix = F.when(F.col("field") == "", F.lit("")).otherwise(F.concat("field", F.lit(".")))
        members = nested.filter("type = 'object'").select(prefix.alias("p"), F.explode(F.variant_get("v", "$", "map<string,variant>")).alias("k", "v")).select(F.concat("p", "k").alias("field"), "v")
        elements = nested.filter("type = 'array'").select(F.concat("field", F.lit("[]")).alias("field"), F.explode(F.variant_get("v", "$", "array<variant>")).alias("v"))
        below = members.union(elements)
        below = durable(below.withColumn("type", F.when(F.col("v").isNull() | F.is_variant_null("v"), "null").otherwise(_kind(F.col("v")))), "level")
        discard(level)
        level, done = below, done + 1
        counts.append(durable(level.groupBy("field", "type").agg(F.count(F.lit(1)).alias("n")), "counts"))
    discard(level)
    if not counts:
        return df.sparkSession.createDataFrame([], "field string, type string, n long")
    every = counts[0]
    for more in counts[1:]:
        every = every.union(more)
    return every
