"""Scoring-log payloads: build requests/responses, parse them back into monitoring rows.

Parsing stays in one plan (``from_json`` + field access), so Catalyst prunes
the JSON to the fields used; counts per stage come from ``observe`` in the
same pass instead of extra jobs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.functions import schemas as S
from tidemark.functions.exprs import epoch_ms, nan_to_null

FEATURES = [n for n, _ in S.FEATURE_FIELDS]


# --------------------------------------------------------------------------- build

def build_request(records: Sequence[Sequence[Column]] | None = None, feature_cols: Sequence[str] = FEATURES) -> Column:
    """``{"dataframe_records": [{...}, ...]}`` with missing values kept as JSON null.

    ``records`` is a list of records, each a list of feature Columns in
    ``feature_cols`` order; default is one record made of the named columns.
    """
    if records is None:
        records = [[F.col(c) for c in feature_cols]]
    numeric = {n for n, typ in S.FEATURE_FIELDS if typ == "double"}
    clean = lambda c, n: nan_to_null(c.cast("double")) if n in numeric else c
    structs = [F.struct(*[clean(c, n).alias(n) for c, n in zip(rec, feature_cols)]) for rec in records]
    return F.to_json(F.struct(F.array(*structs).alias(S.RECORDS_FIELD)), {"ignoreNullFields": "false"})


def build_response(predictions: Column, request_id: Column) -> Column:
    """``{"predictions": [...], "databricks_output": {"trace": null, "databricks_request_id": id}}``."""
    output = F.struct(F.lit(None).cast("string").alias("trace"), request_id.cast("string").alias(S.REQUEST_ID_FIELD))
    return F.to_json(F.struct(predictions.alias(S.PREDICTIONS_FIELD), output.alias(S.OUTPUT_FIELD)),
                     {"ignoreNullFields": "false"})


def build_label_response(predictions: Column) -> Column:
    """The text-label wrapper's answer: ``{"predictions": {"Survival prediction": [...]}}``."""
    labels = F.transform(predictions, lambda p: F.when(p == 1, F.lit("alive")).otherwise(F.lit("dead")))
    return F.to_json(F.struct(F.struct(labels.alias(S.LABEL_FIELD)).alias(S.PREDICTIONS_FIELD)))


# --------------------------------------------------------------------------- parse

def parse_request(df: DataFrame, request_col: str = "request") -> DataFrame:
    """Adds ``parsed_request`` (array of typed records); a bad field is null, siblings survive."""
    return df.withColumn("parsed_request", F.from_json(F.col(request_col), S.REQUEST_SCHEMA))


def predictions_from_text(text: Column) -> Column:
    """Integer predictions from the raw ``predictions`` JSON fragment.

    First as an integer array; if that yields null, as the text-label shape
    (``alive`` -> 1, ``dead`` -> 0).  Only the small fragment is re-parsed.
    """
    as_int = F.from_json(text, S.PREDICTIONS_SCHEMA)
    labels = F.from_json(text, S.LABELS_SCHEMA)[S.LABEL_FIELD]
    from_labels = F.transform(labels, lambda s: F.when(s == "alive", F.lit(1)).when(s == "dead", F.lit(0)))
    return F.coalesce(as_int, from_labels)


def predictions_expr(response_col: str = "response") -> Column:
    """Integer predictions from either response shape (see ``predictions_from_text``)."""
    return predictions_from_text(F.from_json(F.col(response_col), S.RESPONSE_RAW_SCHEMA)[S.PREDICTIONS_FIELD])


def parse_response(df: DataFrame, response_col: str = "response") -> DataFrame:
    """Adds ``predictions`` (array<int>) and ``served_request_id``; the response text is parsed once."""
    parsed = df.withColumn("_resp", F.from_json(F.col(response_col), S.RESPONSE_RAW_SCHEMA))
    return parsed.withColumns({
        "predictions": predictions_from_text(F.col("_resp")[S.PREDICTIONS_FIELD]),
        "served_request_id": F.col("_resp")[S.OUTPUT_FIELD][S.REQUEST_ID_FIELD],
    }).drop("_resp")


def explode_records(df: DataFrame, keep_empty: bool = False) -> DataFrame:
    """One row per record with its 0-based position.

    Requests with null, empty or unparsable record arrays vanish; with
    ``keep_empty`` they stay as one row with null record (``posexplode_outer``).
    """
    fn = F.posexplode_outer if keep_empty else F.posexplode
    return df.select("*", fn(F.col("parsed_request")[S.RECORDS_FIELD]).alias("record_pos", "record"))


def first_prediction(df: DataFrame) -> DataFrame:
    """Prediction 0 for every record (the reference's rule); null if there is none."""
    return df.withColumn("prediction", F.get(F.col("predictions"), 0).cast("int"))


def align_predictions(df: DataFrame) -> DataFrame:
    """Record i gets prediction i; equals ``first_prediction`` for one-record requests."""
    return df.withColumn("prediction", F.get(F.col("predictions"), F.col("record_pos")).cast("int"))


def flatten_record(df: DataFrame, model_name: str | Column, time_col: str = "request_time") -> DataFrame:
    """Monitoring-table projection: ids, time, the ten features, prediction, model."""
    model = model_name if isinstance(model_name, Column) else F.lit(model_name)
    cols = [
        F.col(time_col).alias("timestamp"),
        epoch_ms(time_col).alias("timestamp_ms"),
        F.col(S.REQUEST_ID_FIELD),
        F.col("execution_duration_ms"),
        F.col("record_pos"),
    ]
    for name, typ in S.FEATURE_FIELDS:
        c = F.col(f"record.{name}")
        cols.append((nan_to_null(c.cast("double")) if typ == "double" else c).alias(name))
    cols += [F.col("prediction").cast("int").alias("prediction"), model.alias("model_name")]
    return df.select(*cols)


def drop_null_prediction(df: DataFrame) -> DataFrame:
    return df.dropna(subset=["prediction"])


def valid_or_all(df: DataFrame) -> DataFrame:
    """Rows with a prediction; if no row has one, every row is kept instead.

    The branch is an uncorrelated ``EXISTS`` subquery (``DataFrame.exists``)
    inside the same lazy plan: it stops at the first valid row, and nothing
    is decided on the driver at definition time.
    """
    has_prediction = F.col("prediction").isNotNull()
    return df.filter(has_prediction | ~df.filter(has_prediction).exists())


def payload_to_monitor(payload: DataFrame, model_name: str | Column, align: bool = False,
                       keep_all_if_no_prediction: bool = True,
                       observation: Observation | None = None) -> DataFrame:
    """Payload log -> monitoring rows (one per scored record).

    ``align=False`` reproduces the reference (prediction 0 for every record);
    ``align=True`` pairs record i with prediction i.  An ``Observation``
    counts the final rows (and those with a prediction) in the consumer's
    own pass; it sits above the ``EXISTS`` subquery of ``valid_or_all``,
    whose early stop must not feed it.
    """
    parsed = parse_response(parse_request(payload))
    rows = explode_records(parsed)
    rows = align_predictions(rows) if align else first_prediction(rows)
    flat = flatten_record(rows, model_name)
    out = valid_or_all(flat) if keep_all_if_no_prediction else drop_null_prediction(flat)
    if observation is not None:
        out = out.observe(observation, F.count(F.lit(1)).alias("n_rows"),
                          F.count("prediction").alias("n_with_prediction"))
    return out


def stage_counts(payload: DataFrame) -> DataFrame:
    """Rows read, records exploded, records with a prediction, rows kept - one pass.

    Counts per request are summed, so no row is exploded just to be counted.
    """
    parsed = parse_response(parse_request(payload))
    n_rec = F.coalesce(F.array_size(F.col("parsed_request")[S.RECORDS_FIELD]), F.lit(0))
    has_pred = F.get(F.col("predictions"), 0).isNotNull()
    agg = parsed.agg(
        F.count(F.lit(1)).alias("n_read"),
        F.sum(n_rec).alias("n_exploded"),
        F.sum(F.when(has_pred, n_rec).otherwise(F.lit(0))).alias("n_valid"),
    )
    return agg.withColumn("n_final", F.when(F.col("n_valid") > 0, F.col("n_valid")).otherwise(F.col("n_exploded")))


# --------------------------------------------------------------------------- quarantine

def quarantine(payload: DataFrame, request_col: str = "request",
               fields: Sequence[tuple[str, str, bool]] | None = None) -> DataFrame:
    """Per record: ``status`` valid/rejected and the first failing ``reason``.

    Requests are read twice in one projection: typed, and with every field as
    text.  A field present as text whose typed value is null had the wrong
    type; fields that a record lacks or has beyond the declared ones are
    reasons of their own, by name.  (Casting the text instead of the typed read would differ: Spark
    re-quotes bare NaN in text mode.)  Unparsable requests and empty record
    lists keep one rejected row (``posexplode_outer``), so nothing disappears
    silently.  ``fields`` (name, type, required) replaces the declared ones, as
    ``signature.signature_fields`` gives them from a learned signature; a
    record may lack those that are not required.
    """
    if fields is None:
        declared, schema, raw_schema = [(n, typ, True) for n, typ in S.FEATURE_FIELDS], S.REQUEST_SCHEMA, S.RAW_REQUEST_SCHEMA
    else:
        declared = list(fields)
        quoted = [(n.replace("`", "``"), typ) for n, typ, _ in declared]
        schema, raw_schema = (f"`{S.RECORDS_FIELD}` array<struct<" + ", ".join(f"`{n}`: {read(typ)}" for n, typ in quoted) + ">>"
                              for read in (lambda typ: typ, lambda typ: "string"))
    typed = F.from_json(F.col(request_col), schema)[S.RECORDS_FIELD]
    raw = F.from_json(F.col(request_col), raw_schema)[S.RECORDS_FIELD]
    text = F.from_json(F.col(request_col), f"`{S.RECORDS_FIELD}` array<string>")[S.RECORDS_FIELD]
    names, needed = (F.array(*[F.lit(n) for n in part]).cast("array<string>")
                     for part in ([n for n, _, _ in declared], [n for n, _, must in declared if must]))
    pairs = F.arrays_zip(typed.alias("t"), raw.alias("r"), F.transform(text, F.json_object_keys).alias("k"))
    df = payload.select(S.REQUEST_ID_FIELD, typed.isNull().alias("_unparsed"),
                        F.posexplode_outer(pairs).alias("record_pos", "_rec"))
    reason = F.when(F.col("_unparsed"), F.lit("unparsable_request")).when(
        F.col("_rec").isNull(), F.lit("no_records"))
    missing, unknown = F.array_except(needed, F.col("_rec.k")), F.array_except(F.col("_rec.k"), names)
    reason = reason.when(F.size(missing) > 0, F.concat(F.lit("missing:"), F.get(missing, 0)))
    reason = reason.when(F.size(unknown) > 0, F.concat(F.lit("unknown:"), F.get(unknown, 0)))
    for name, typ, _ in declared:
        if typ != "string":
            t, r = F.col("_rec.t").getField(name), F.col("_rec.r").getField(name)
            reason = reason.when(r.isNotNull() & t.isNull(), F.lit(f"bad_type:{name}"))
    return df.select(S.REQUEST_ID_FIELD, F.col("record_pos"),
                     F.when(reason.isNull(), F.lit("valid")).otherwise(F.lit("rejected")).alias("status"),
                     reason.alias("reason"))


# --------------------------------------------------------------------------- score + log

def score_and_log(requests: DataFrame, scorer: Callable[[DataFrame], DataFrame], request_id: Column,
                  request_time: Column, feature_cols: Sequence[str] = FEATURES,
                  duration_ms: Column | None = None) -> DataFrame:
    """Batch stand-in for endpoint calls: rows -> request JSON -> scorer -> response JSON.

    ``scorer`` maps the feature rows to a DataFrame with an int ``prediction``
    column (an MLlib ``PipelineModel.transform`` or any expression).
    """
    scored = scorer(requests.withColumn(S.REQUEST_ID_FIELD, request_id.cast("string"))
                    .withColumn("request_time", request_time))
    return scored.select(
        F.col("request_time"),
        F.col(S.REQUEST_ID_FIELD),
        (duration_ms if duration_ms is not None else F.lit(0).cast("long")).alias("execution_duration_ms"),
        build_request(feature_cols=feature_cols).alias("request"),
        build_response(F.array(F.col("prediction").cast("int")), F.col(S.REQUEST_ID_FIELD)).alias("response"),
    )
