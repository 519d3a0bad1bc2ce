"""Statistical checks for synthesis; smoke checks for MLlib training and A/B scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import model as Mo, synth
from tidemark.plans import standins as D
from tidemark.sources.tables import table


def test_synth_numeric_moments(spark, sf_small):
    ev = table(spark, sf_small, "events")
    src = ev.agg(F.avg("value").alias("m"), F.stddev_samp("value").alias("s")).first()
    out = synth.synth_numeric(spark, ev, "value", 20000).agg(F.avg("value").alias("m"), F.stddev_samp("value").alias("s")).first()
    assert abs(out["m"] - src["m"]) < 0.05 * src["s"] + 0.5
    assert abs(out["s"] - src["s"]) < 0.1 * src["s"] + 0.5


def test_synth_categorical_shares(spark, sf_small):
    ev = table(spark, sf_small, "events")
    n = ev.count()
    src = {r["event_type"]: r["count"] / n for r in ev.groupBy("event_type").count().collect()}
    out = synth.synth_categorical(spark, ev, "event_type", 20000)
    got = {r["event_type"]: r["count"] / 20000 for r in out.groupBy("event_type").count().collect()}
    assert set(got) == set(src)
    assert all(abs(got[k] - src[k]) < 0.02 for k in src)


def test_drift_scales_and_redraws(spark, sf_small):
    ev = table(spark, sf_small, "events")
    kw = dict(numeric=["value"], floored=["value"], categorical=["event_type"], timestamps=["ts"],
              drift_scale=["value"], drift_col="event_type", drift_weights={"click": 0.7, "view": 0.3})
    base = synth.synth_table(spark, ev, 5000, **kw)
    drifted = synth.synth_table(spark, ev, 5000, drift=True, **kw)
    ratio = drifted.agg(F.avg("value")).first()[0] / base.agg(F.avg("value")).first()[0]
    assert abs(ratio - 1.5) < 1e-6
    mix = {r["event_type"]: r["count"] for r in drifted.groupBy("event_type").count().collect()}
    assert set(mix) == {"click", "view"} and 0.65 < mix["click"] / 5000 < 0.75


def test_train_score_and_ab(spark, sf_small):
    docs = D.scored_documents(spark, sf_small)
    fitted = Mo.train_classifier(docs, ["lang", "source"], ["n_chars"], "y", {"maxIter": 3, "maxDepth": 2})
    scored = Mo.batch_score(fitted, docs, keep=["doc_id", "y"], text_label=True)
    assert scored.count() == docs.count()
    assert scored.filter(~F.col("prediction").isin(0, 1)).count() == 0
    ab = Mo.ab_score(fitted, fitted, docs, "doc_id", keep=["y"])
    routed = {r["doc_id"]: r["model"] for r in ab.collect()}
    again = {r["doc_id"]: r["arm"] for r in Mo.ab_route(docs, "doc_id").collect()}
    assert all(routed[k] == f"Model {again[k]}" for k in routed)
    assert Mo.ab_summary(ab, "y").count() == 2


def test_generate_synthetic_data_like_reference(spark, sf_small):
    from tidemark.operators.clean import clean_table
    cleaned = clean_table(D.raw_characters(spark, sf_small))
    for drift in (False, True):
        out = synth.generate_test_data(spark, cleaned, drift=drift, categorical=["Alive"], base_id=1000)
        assert out.count() == synth.TEST_ROWS
        assert set(out.columns) == set(cleaned.columns)
        assert out.filter((F.col("Height") < 0.1) | (F.col("Weight") < 0.1)).count() == 0
        assert {r["Alive"] for r in out.select("Alive").distinct().collect()} <= {0, 1}
        ids = [r["Id"] for r in out.select("Id").collect()]
        assert sorted(ids) == sorted(str(1000 + i) for i in range(synth.TEST_ROWS))
    genders = {r["Gender"] for r in out.select("Gender").distinct().collect()}
    assert genders <= {"Male", "Female"}
