"""Signatures learned from JSON records: which fields occur, of which type, and how two signatures differ.

Records are read as ``VARIANT``, so nothing about them need be known.  Every
record becomes (field, type) pairs that are counted in one partial aggregate;
what a field holds is merged from these few counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize

MAX_FIELDS = 10_000
TEXT_TYPES = ("string", "mixed", "void", "array", "object")


def _kind(schema: Column) -> Column:
    """``DECIMAL(3,1)`` and ``DOUBLE`` are double, ``OBJECT<...>`` is object; other names as they are, in lower case."""
    head = F.lower(F.regexp_extract(schema, "^[A-Za-z]+", 0))
    return F.when(head.isin("decimal", "float", "double"), "double").otherwise(head)


def learn_signature(records: DataFrame, json_col: str) -> DataFrame:
    """One row per top-level field: ``type``, ``n_present``, ``n_null``, ``n_records`` and ``required``.

    Whole numbers and fractions merge to ``double``, other different types to ``mixed``; a field that is null
    wherever it occurs is ``void``.  A field is required if every record has it, null or not.  Rows that hold no JSON
    object (null, unparsable, repeated field names, arrays, bare values) are no records; empty objects are.
    """
    parsed = records.select(F.try_parse_json(F.col(f"`{json_col}`")).alias("_v"))
    objects = parsed.filter(F.schema_of_variant("_v").startswith("OBJECT"))
    view = objects.lateralJoin(objects.sparkSession.tvf.variant_explode_outer(F.col("_v").outer()))
    # A record's first field has position 0 and an empty record a null one: both count it once.
    counts = materialize(view.groupBy(F.col("key").alias("field"), _kind(F.schema_of_variant("value")).alias("kind")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.coalesce(F.col("pos"), F.lit(0)) == 0).alias("_records")))
    total = counts.agg(F.coalesce(F.sum("_records"), F.lit(0))).first()[0]
    real = F.when(F.col("kind") != "void", F.col("kind"))
    merged = counts.filter(F.col("field").isNotNull()).groupBy("field").agg(
        F.array_sort(F.collect_set(real)).alias("_kinds"), F.sum("n").alias("n_present"),
        F.coalesce(F.sum(F.when(F.col("kind") == "void", F.col("n"))), F.lit(0)).alias("n_null"))
    kinds = F.col("_kinds")
    typed = (F.when(F.size(kinds) == 0, "void").when(F.size(kinds) == 1, F.get(kinds, 0))
             .when(kinds == F.array(F.lit("bigint"), F.lit("double")), "double").otherwise("mixed"))
    return merged.select("field", typed.alias("type"), "n_present", "n_null", F.lit(total).cast("long").alias("n_records"),
                         (F.col("n_present") == F.lit(total)).alias("required"))


def compare_signatures(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Per field of either signature: ``missing``, ``unknown``, ``same``, ``widened``, ``narrowed`` or ``changed``.

    A type is wider if it holds every value of the other: double than bigint, mixed than all, all than void.  With
    equal types, a field that was required and no longer is counts as widened, the reverse as narrowed.
    """
    e = expected.select("field", F.col("type").alias("expected_type"), F.col("required").alias("_e"))
    a = actual.select("field", F.col("type").alias("actual_type"), F.col("required").alias("_a"))
    old, new = F.col("expected_type"), F.col("actual_type")
    wider = lambda big, small: (big == "mixed") | (small == "void") | ((big == "double") & (small == "bigint"))
    change = (F.when(new.isNull(), "missing").when(old.isNull(), "unknown")
              .when((old == new) & (F.col("_e") == F.col("_a")), "same")
              .when(old == new, F.when(F.col("_e"), "widened").otherwise("narrowed"))
              .when(wider(new, old), "widened").when(wider(old, new), "narrowed").otherwise("changed"))
    return e.join(a, "field", "full_outer").select("field", "expected_type", "actual_type", change.alias("change"))


def signature_fields(signature: DataFrame) -> list[tuple[str, str, bool]]:
    """(name, type to read it as, required) by name, for parsers.  A learned signature is a schema and has a schema's
    size; more than ``MAX_FIELDS`` fields (ids used as names) are refused."""
    rows: Sequence = signature.select("field", "type", "required").orderBy("field").limit(MAX_FIELDS + 1).collect()
    if len(rows) > MAX_FIELDS:
        raise ValueError(f"the signature has more than {MAX_FIELDS} fields; its names look like data")
    return [(r["field"], "string" if r["type"] in TEXT_TYPES else r["type"], r["required"]) for r in rows]
