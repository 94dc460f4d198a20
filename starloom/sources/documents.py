"""Documents whose schema is inferred and drifts (SRC1, DQ2).

The reference's source is a document store: the connector samples documents, infers
one schema and reads everything by it, so a field that changes its type or comes late
is lost or fails.  Here documents are read as text and parsed into VARIANT values:

* ``drift_report`` counts, over all documents, which kinds of values every field has,
  and joins them in a lattice (integer < decimal < double, void below all, anything
  else that differs is text): the schema to pin, seen before it is pinned;
* ``scan_documents`` reads by a pinned schema in one projection.  A value that does not
  fit its field, and a field that is not in the schema, go to a rescue column as they
  stand; a text that is no object goes to another.  Nothing is dropped or coerced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Kinds of values that fit a pinned type without loss.
FITS = {
    "bigint": ("BIGINT",),
    "int": ("BIGINT",),
    "double": ("BIGINT", "DECIMAL", "DOUBLE"),
    "string": ("STRING",),
    "boolean": ("BOOLEAN",),
}
_WIDTH = {"VOID": 0, "BIGINT": 1, "DECIMAL": 2, "DOUBLE": 3}


def kind(value: Column) -> Column:
    """VOID, BIGINT, DECIMAL, DOUBLE, STRING, BOOLEAN, OBJECT or ARRAY."""
    return F.regexp_extract(F.schema_of_variant(value), "^([A-Z]+)", 1)


def _fields(text: Column) -> Column:
    """The document as a map of its fields; null if it is no JSON object."""
    value = F.try_parse_json(text)
    # an array, a number or a lone null is no document
    return F.when(kind(value) == "OBJECT", value).cast("map<string,variant>")


def drift_report(docs: DataFrame, column: str) -> DataFrame:
    """(field, kind, documents, merged): how many documents have a value of the kind in
    the field, and the kind that holds all of the field's; malformed documents are
    counted under a null field.  Counted in one pass, combined before it shuffles."""
    fields = docs.select(_fields(F.col(f"`{column}`")).alias("fields"))
    none = F.array(F.struct(F.lit(None).cast("string").alias("field"), F.lit("MALFORMED").alias("kind")))
    each = F.transform(F.map_entries("fields"), lambda e: F.struct(e["key"].alias("field"), kind(e["value"]).alias("kind")))
    counts = fields.select(F.explode(F.coalesce(each, none)).alias("e")).select("e.*").groupBy("field", "kind").agg(F.count(F.lit(1)).alias("documents"))
    width = F.coalesce(*[F.when(F.col("kind") == k, w) for k, w in _WIDTH.items()])
    solid = F.collect_set(F.when(F.col("kind") != "VOID", F.col("kind")))  # at most a handful of kinds
    merged = counts.groupBy(F.col("field").alias("f2")).agg(solid.alias("kinds"), F.max(F.when(width > 0, width)).alias("widest"),
                                                            F.count_if(width.isNull()).alias("others"))
    names = F.element_at(F.array(*[F.lit(k) for k in _WIDTH]), F.col("widest") + 1)
    one = F.when(F.size("kinds") == 0, "VOID").when(F.size("kinds") == 1, F.element_at("kinds", 1)).when(F.col("others") == 0, names).otherwise("STRING")
    return counts.join(merged.select("f2", one.alias("merged")), F.col("field").eqNullSafe(F.col("f2"))).drop("f2")


def scan_documents(docs: DataFrame, column: str, schema: T.StructType | str, rescue: str = "_rescued", malformed: str = "_malformed") -> DataFrame:
    """The columns of ``schema``, ``rescue`` (map of field to JSON text, null if all fits)
    and ``malformed`` (the text, where it is no JSON object).  A field that is missing or
    null is null; integers that a type cannot hold are rescued.  One projection."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    for f in schema.fields:
        if f.dataType.simpleString() not in FITS:
            raise ValueError(f"{f.name}: pin one of {sorted(FITS)}")
    rows = docs.withColumn("__fields", _fields(F.col(f"`{column}`")))
    value = {f.name: F.try_element_at("__fields", F.lit(f.name)) for f in schema.fields}
    cast = {f.name: F.when(kind(value[f.name]).isin(*FITS[f.dataType.simpleString()]), F.try_variant_get(value[f.name], "$", f.dataType.simpleString()))
            for f in schema.fields}
    rows = rows.withColumns({f"__v_{name}": c for name, c in cast.items()})
    void = lambda v: kind(v) == "VOID"

    def kept_out(k: Column, v: Column) -> Column:
        fits = F.lit(False)
        for f in schema.fields:
            fits = fits | ((k == f.name) & (F.col(f"`__v_{f.name}`").isNotNull() | void(v)))
        return ~fits

    left = F.transform_values(F.map_filter("__fields", kept_out), lambda k, v: F.to_json(v))
    return rows.select(*[F.col(f"`__v_{f.name}`").alias(f.name) for f in schema.fields],
                       F.when(F.size(left) > 0, left).alias(rescue), F.when(F.col("__fields").isNull(), F.col(f"`{column}`")).alias(malformed))
