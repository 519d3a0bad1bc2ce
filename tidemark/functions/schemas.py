"""JSON schemas of the scoring request / response log."""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, DoubleType, IntegerType, StringType, StructField,
                               StructType)

# ---------------------------------------------------------------------------
# Field names of the serving log format.
# ---------------------------------------------------------------------------
RECORDS_FIELD = "dataframe_records"
PREDICTIONS_FIELD = "predictions"
OUTPUT_FIELD = "databricks_output"
REQUEST_ID_FIELD = "databricks_request_id"
LABEL_FIELD = "Survival prediction"
FEATURE_FIELDS = (
    ("Height", "double"), ("Weight", "double"), ("Universe", "string"), ("Identity", "string"),
    ("Gender", "string"), ("Marital_Status", "string"), ("Teams", "string"), ("Origin", "string"),
    ("Magic", "string"), ("Mutant", "string"),
)
# ---------------------------------------------------------------------------

_TYPES = {"double": DoubleType(), "string": StringType(), "int": IntegerType()}

RECORD_SCHEMA = StructType([StructField(n, _TYPES[t], True) for n, t in FEATURE_FIELDS])
REQUEST_SCHEMA = StructType([StructField(RECORDS_FIELD, ArrayType(RECORD_SCHEMA), True)])
# Every field read as raw text: used to tell a wrong-typed value from a missing one.
RAW_RECORD_SCHEMA = StructType([StructField(n, StringType(), True) for n, _ in FEATURE_FIELDS])
RAW_REQUEST_SCHEMA = StructType([StructField(RECORDS_FIELD, ArrayType(RAW_RECORD_SCHEMA), True)])

RESPONSE_SCHEMA = StructType([
    StructField(PREDICTIONS_FIELD, ArrayType(IntegerType()), True),
    StructField(OUTPUT_FIELD, StructType([
        StructField("trace", StringType(), True),
        StructField(REQUEST_ID_FIELD, StringType(), True),
    ]), True),
])
# One parse of the whole response: predictions kept as raw JSON text, decoded below.
RESPONSE_RAW_SCHEMA = StructType([
    StructField(PREDICTIONS_FIELD, StringType(), True),
    StructField(OUTPUT_FIELD, RESPONSE_SCHEMA[OUTPUT_FIELD].dataType, True),
])
PREDICTIONS_SCHEMA = ArrayType(IntegerType())
LABELS_SCHEMA = StructType([StructField(LABEL_FIELD, ArrayType(StringType()), True)])
