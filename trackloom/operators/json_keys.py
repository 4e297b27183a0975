"""Keys of JSON records whose shape is not known, with the types of their values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Groups of the types that ``schema_of_variant`` names.
KINDS = ("object", "array", "string", "number", "boolean", "null")


def _kind(value: Column) -> Column:
    """The JSON type of a variant, as one of ``KINDS``; a JSON null is ``null``."""
    name = F.schema_of_variant(value)
    return (
        F.when(F.is_variant_null(value) | (name == "VOID"), "null")
        .when(name.startswith("OBJECT"), "object")
        .when(name.startswith("ARRAY"), "array")
        .when(name == "STRING", "string")
        .when(name == "BOOLEAN", "boolean")
        .otherwise("number")
    )


def _length(kind: Column, value: Column) -> Column:
    """Signs of a string, items of an array, keys of an object; null for other values."""
    return (
        F.when(kind == "string", F.char_length(F.try_variant_get(value, "$", "string")))
        .when(kind == "array", F.size(F.try_variant_get(value, "$", "array<variant>")))
        .when(kind == "object", F.size(F.try_variant_get(value, "$", "map<string,variant>")))
    )


def _node(path: Column, value: Column) -> Column:
    return F.struct(path.alias("path"), value.alias("value"), _kind(value).alias("kind"))


def _members(parents: Column) -> Column:
    """The values one level down: members of objects under their key, items of arrays under ``[]``."""

    def inside(parent: Column) -> Column:
        path, value, kind = parent["path"], parent["value"], parent["kind"]
        of_object = F.transform(
            F.map_entries(F.try_variant_get(value, "$", "map<string,variant>")),
            lambda e: _node(F.concat(path, F.when(path == "", "").otherwise("."), e["key"]), e["value"]),
        )
        of_array = F.transform(
            F.try_variant_get(value, "$", "array<variant>"), lambda item: _node(F.concat(path, F.lit("[]")), item)
        )
        return F.when(kind == "object", of_object).when(kind == "array", of_array)

    return F.flatten(F.filter(F.transform(parents, inside), F.isnotnull))


def json_values(records: DataFrame, text: str, levels: int = 2) -> DataFrame:
    """Every value of JSON records down to a number of levels: path, kind, length.

    The record itself has the empty path; ``a.b`` is a member, ``a[]`` any item of
    an array. A text that is not JSON, or has a key twice in one object, has one
    row of kind ``invalid``, a null one of kind ``missing``. A text is parsed once,
    and one generator gives all its values; nothing is shuffled.
    """
    found = records.select(F.col(text).alias("text"), F.try_parse_json(text).alias("value"))
    kind = F.when(F.col("text").isNull(), "missing").when(F.col("value").isNull(), "invalid").otherwise(_kind(F.col("value")))
    found = found.select(F.array(F.struct(F.lit("").alias("path"), F.col("value"), kind.alias("kind"))).alias("l0"))
    for i in range(levels):
        found = found.withColumn(f"l{i + 1}", _members(F.col(f"l{i}")))
    values = found.select(F.inline(F.concat(*[f"l{i}" for i in range(levels + 1)])))
    return values.select("path", "kind", _length(F.col("kind"), F.col("value")).alias("length"))


def json_key_profile(records: DataFrame, text: str, levels: int = 2) -> DataFrame:
    """One row per path: its values, how many are of each type, and their smallest and largest length.

    Keys need not be known and their number grows with the data, so they stay a
    table. The aggregate combines before its one shuffle: a key that all records
    have is one row a task.
    """
    kinds = (*KINDS, "invalid", "missing")
    return json_values(records, text, levels).groupBy("path").agg(
        F.count("*").alias("values"), *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in kinds],
        F.min("length").alias("min_length"), F.max("length").alias("max_length"),
    )
