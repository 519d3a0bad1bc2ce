"""Payload parsing edge cases (FIXTURES.md section 4) and monitor-row invariants."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import payload as P

REC = '{"Height": %s, "Weight": 80.0, "Universe": "Earth-616", "Identity": "Public", "Gender": "Male", ' \
      '"Marital_Status": "Single", "Teams": %s, "Origin": "Human", "Magic": "0", "Mutant": "0"}'


def _payload(spark, rows):
    return spark.createDataFrame(
        [(req, resp, f"r{i}", i) for i, (req, resp) in enumerate(rows)],
        "request string, response string, databricks_request_id string, execution_duration_ms long",
    ).withColumn("request_time", F.lit("2024-01-01 00:10:00").cast("timestamp_ntz"))


def test_response_shapes(spark):
    one = '{"dataframe_records": [%s]}' % (REC % ("1.8", '"Avengers"'))
    rows = [(one, '{"predictions":[1,0]}'), (one, '{"predictions":{"Survival prediction":["alive"]}}'),
            (one, '{"predictions":[1.5]}'), (one, '{"predictions":[]}'), (one, "not json")]
    got = [r["prediction"] for r in P.first_prediction(P.parse_response(_payload(spark, rows)))
           .orderBy("databricks_request_id").collect()]
    assert got == [1, 1, None, None, None]


def test_requests_that_vanish(spark):
    rows = [('{"dataframe_records":[]}', "{}"), ('{"dataframe_records":null}', "{}"), ("nope", "{}")]
    parsed = P.parse_request(_payload(spark, rows))
    assert P.explode_records(parsed).count() == 0
    assert P.explode_records(parsed, keep_empty=True).count() == 3
    q = {r["databricks_request_id"]: r["reason"] for r in P.quarantine(_payload(spark, rows)).collect()}
    assert q == {"r0": "no_records", "r1": "unparsable_request", "r2": "unparsable_request"}


def test_field_types(spark):
    rows = [('{"dataframe_records": [%s]}' % (REC % ('"x"', "1")), '{"predictions":[1]}'),
            ('{"dataframe_records": [%s]}' % (REC % ("NaN", "1")), '{"predictions":[0]}')]
    mon = P.payload_to_monitor(_payload(spark, rows), "m").orderBy("databricks_request_id").collect()
    assert mon[0]["Height"] is None and mon[0]["Weight"] == 80.0 and mon[0]["Teams"] == "1"
    assert mon[1]["Height"] is None  # NaN nulled
    q = {r["databricks_request_id"]: r["reason"] for r in P.quarantine(_payload(spark, rows)).collect()}
    assert q == {"r0": "bad_type:Height", "r1": None}


def test_align_equals_first_for_single_records(spark):
    one = '{"dataframe_records": [%s]}' % (REC % ("1.8", "1"))
    two = '{"dataframe_records": [%s, %s]}' % (REC % ("1.8", "1"), REC % ("1.7", "0"))
    rows = [(one, '{"predictions":[1]}'), (two, '{"predictions":[0,1]}')]
    ex = P.explode_records(P.parse_response(P.parse_request(_payload(spark, rows))))
    first = {(r[0], r[1]): r[2] for r in P.first_prediction(ex).select("databricks_request_id", "record_pos", "prediction").collect()}
    align = {(r[0], r[1]): r[2] for r in P.align_predictions(ex).select("databricks_request_id", "record_pos", "prediction").collect()}
    assert first[("r0", 0)] == align[("r0", 0)] == 1
    assert first[("r1", 1)] == 0 and align[("r1", 1)] == 1


def test_valid_or_all_keeps_everything_without_predictions(spark):
    one = '{"dataframe_records": [%s]}' % (REC % ("1.8", "1"))
    rows = [(one, "oops"), (one, '{"predictions":[]}')]
    assert P.payload_to_monitor(_payload(spark, rows), "m").count() == 2
    assert P.payload_to_monitor(_payload(spark, rows), "m", keep_all_if_no_prediction=False).count() == 0


def test_build_request_roundtrip(spark):
    df = spark.createDataFrame([(1.5, None, "a")], "Height double, Weight double, Universe string")
    feats = P.FEATURES
    cols = [F.col(c) if c in df.columns else F.lit(None).cast("string") for c in feats]
    text = df.select(P.build_request([cols]).alias("request")).first()["request"]
    assert '"Weight":null' in text and '"Height":1.5' in text
    back = P.explode_records(P.parse_request(df.select(P.build_request([cols]).alias("request")))).first()
    assert back["record"]["Height"] == 1.5 and back["record"]["Universe"] == "a"
