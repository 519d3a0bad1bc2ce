"""Registered queries: one per operator key, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables (through ``standins`` where the
reference's data shape must be derived) and runs over whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import exprs as X
from tidemark.functions import schemas as S
from tidemark.operators import asof, clean, features, metrics, model, monitor, payload as P, profile, runs, sampling, signature, synth
from tidemark.plans import standins as D
from tidemark.plans.partitioning import spread
from tidemark.session import pin_utc, scratch_path
from tidemark.sources import csv as csvsrc
from tidemark.sources import monitor_sink, monitor_state, runs_json, snapshots
from tidemark.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        pin_utc(spark)
        return fn(spark, sf_dir)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run
    return run


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events")


# --------------------------------------------------------------------------- 2.2 projections

@query
def rename_select(spark, sf_dir):
    ev = _events(spark, sf_dir)
    out = clean.rename_select(ev, {"value": "Value", "event_type": "Event_Type", "event_id": "Id"},
                              keep=["Value", "Event_Type", "Id"])
    return out.withColumn("Id", F.col("Id").cast("string"))


@query
def fill_unknown(spark, sf_dir):
    ev = _events(spark, sf_dir)
    return ev.select("event_id", X.fill_unknown(F.nullif(F.col("event_type"), F.lit("error"))).alias("event_type"))


@query
def replace_value(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", X.replace_value("event_type", "view", "page_view").alias("event_type"))


@query
def presence_flag(spark, sf_dir):
    ev = _events(spark, sf_dir)
    return ev.select("event_id", X.presence_flag(F.nullif(F.col("event_type"), F.lit("error"))).alias("has_type"))


@query
def whitelist_other(spark, sf_dir):
    ev = _events(spark, sf_dir)
    filled = X.fill_unknown(F.nullif(F.col("event_type"), F.lit("error")))
    return ev.select("event_id", X.whitelist_other(filled, ["click", "view"]).alias("event_type"))


@query
def in_list_filter(spark, sf_dir):
    ev = _events(spark, sf_dir)
    return ev.filter(F.col("event_type").isin("click", "purchase", "signup")).select("event_id", "event_type")


@query
def binary_target(spark, sf_dir):
    ev = _events(spark, sf_dir)
    return ev.select("event_id", X.binary_target(F.nullif(F.col("event_type"), F.lit("error")), "purchase").alias("target"))


@query
def cast_columns(spark, sf_dir):
    ev = _events(spark, sf_dir)
    k = F.regexp_extract("props", r"(-?\d+)", 1)
    return ev.select(F.col("event_id").cast("string").alias("Id"),
                     F.floor("value").cast("int").alias("value_int"),
                     F.col("user_id").cast("double").alias("user_id_double"),
                     k.try_cast("int").alias("k"),
                     F.col("props").try_cast("int").alias("props_int"))


@query
def epoch_ms(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", X.epoch_ms("ts").alias("timestamp_ms"))


@query
def clip_scale(spark, sf_dir):
    ev = _events(spark, sf_dir)
    v = F.when(F.col("event_type") == "error", F.lit(None)).otherwise(F.col("value") - F.lit(30.0))
    return ev.select("event_id", X.clip_scale(v, 0.1, 1.5).alias("scaled"))


@query
def label_text(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", X.label_text(D.event_prediction()).alias("label"))


# --------------------------------------------------------------------------- keyword features

@query
def keyword_flag(spark, sf_dir):
    docs = spread(table(spark, sf_dir, "documents"))  # whole texts: use every core
    return docs.select("doc_id",
                       X.keyword_flag("text", ["license"]).alias("has_license"),
                       X.keyword_flag("text", ["@"]).alias("has_at"),
                       X.keyword_flag("text", X.MAGIC_KEYWORDS).alias("Magic"),
                       X.keyword_flag("text", X.MUTANT_KEYWORDS).alias("Mutant"))


PART_RULES = ((("hot",), "Hot"), (("ring", "gear"), "Round"), (("rod", "bolt"), "Long"), (("plate",), "Flat"),
              (("widget", "gizmo"), "Device"))


@query
def keyword_category(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return part.select("p_partkey", X.keyword_category("p_name", PART_RULES).alias("category"))


# --------------------------------------------------------------------------- categories

def _doc_category(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.concat(F.col("source"), F.lit("_"), F.col("lang")).alias("category"))


@query
def value_counts(spark, sf_dir):
    return clean.value_counts(_doc_category(spark, sf_dir), "category")


@query
def value_shares(spark, sf_dir):
    return profile.value_shares(_doc_category(spark, sf_dir), "category")


@query
def distinct_values(spark, sf_dir):
    return profile.distinct_values(_doc_category(spark, sf_dir), "category")


@query
def rare_to_other(spark, sf_dir):
    return clean.rare_to_other(_doc_category(spark, sf_dir), "category", 20)


@query
def clean_table(spark, sf_dir):
    """The whole cleaning chain over a character table derived from orders x customer x nation."""
    return clean.clean_table(D.raw_characters(spark, sf_dir))


@query
def csv_scan(spark, sf_dir):
    """nation written as CSV with pandas' missing tokens, read back with a fixed schema."""
    nation = table(spark, sf_dir, "nation")
    path = scratch_path(spark, "csv_scan")
    dirty = nation.select(
        F.col("n_nationkey").cast("string").alias("n_nationkey"),
        F.when(F.col("n_regionkey") == 0, "NA").when(F.col("n_regionkey") == 1, "null")
         .otherwise(F.col("n_name")).alias("n_name"),
        F.concat(F.lit('He said "'), F.col("n_name"), F.lit('", then,\nleft')).alias("quoted"),
        F.when(F.col("n_regionkey") == 4, "nan").otherwise(F.col("n_regionkey").cast("string")).alias("n_regionkey"))
    csvsrc.write_csv(dirty, path)
    return csvsrc.csv_scan(spark, path, "n_nationkey int, n_name string, quoted string, n_regionkey int")


# --------------------------------------------------------------------------- profiles

@query
def numeric_profile(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return profile.numeric_profile(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])


@query
def table_profile(spark, sf_dir):
    return profile.table_profile(table(spark, sf_dir, "orders"))


@query
def date_range(spark, sf_dir):
    return profile.date_range(table(spark, sf_dir, "lineitem"), ["l_shipdate"]).unionByName(
        profile.date_range(table(spark, sf_dir, "orders"), ["o_orderdate"]))


@query
def stage_counts(spark, sf_dir):
    return P.stage_counts(D.events_payload(spark, sf_dir))


# --------------------------------------------------------------------------- payload

@query
def build_request(spark, sf_dir):
    ev = spread(_events(spark, sf_dir))
    return ev.select(F.concat(F.lit("req-"), F.col("event_id").cast("string")).alias(S.REQUEST_ID_FIELD),
                     P.build_request([D.event_record()]).alias("request"))


@query
def parse_request(spark, sf_dir):
    parsed = P.parse_request(D.events_payload(spark, sf_dir))
    return parsed.select(S.REQUEST_ID_FIELD, F.array_size(F.col("parsed_request")[S.RECORDS_FIELD]).alias("n_records"))


@query
def parse_response(spark, sf_dir):
    parsed = P.parse_response(D.events_payload(spark, sf_dir))
    return parsed.select(S.REQUEST_ID_FIELD, F.array_size("predictions").alias("n_predictions"),
                         F.get(F.col("predictions"), 0).alias("first_prediction"), "served_request_id")


def _exploded(spark, sf_dir):
    return P.explode_records(P.parse_response(P.parse_request(D.events_payload(spark, sf_dir))))


@query
def explode_records(spark, sf_dir):
    return _exploded(spark, sf_dir).select(S.REQUEST_ID_FIELD, "record_pos", F.col("record.Height").alias("Height"),
                                           F.col("record.Weight").alias("Weight"),
                                           F.col("record.Universe").alias("Universe"))


@query
def first_prediction(spark, sf_dir):
    return P.first_prediction(_exploded(spark, sf_dir)).select(S.REQUEST_ID_FIELD, "record_pos", "prediction")


@query
def align_predictions(spark, sf_dir):
    return P.align_predictions(_exploded(spark, sf_dir)).select(S.REQUEST_ID_FIELD, "record_pos", "prediction")


@query
def flatten_record(spark, sf_dir):
    return P.flatten_record(P.first_prediction(_exploded(spark, sf_dir)), D.MODEL_NAME)


@query
def quarantine(spark, sf_dir):
    return P.quarantine(D.events_payload(spark, sf_dir))


@query
def learn_signature(spark, sf_dir):
    return signature.learn_signature(D.loose_records(spark, sf_dir), "record")


@query
def compare_signatures(spark, sf_dir):
    """The signature of closed and pending orders' records against that of open ones'."""
    records = D.loose_records(spark, sf_dir)
    is_open = F.col("o_orderstatus") == "O"
    return signature.compare_signatures(signature.learn_signature(records.filter(~is_open), "record"),
                                        signature.learn_signature(records.filter(is_open), "record"))


@query
def drop_null_prediction(spark, sf_dir):
    return P.drop_null_prediction(P.flatten_record(P.first_prediction(_exploded(spark, sf_dir)), D.MODEL_NAME))


@query
def valid_or_all(spark, sf_dir):
    return P.valid_or_all(P.flatten_record(P.first_prediction(_exploded(spark, sf_dir)), D.MODEL_NAME))


@query
def payload_to_monitor(spark, sf_dir):
    return P.payload_to_monitor(D.events_payload(spark, sf_dir), D.MODEL_NAME)


@query
def monitor_append(spark, sf_dir):
    """Two refreshes over the whole payload log: the second appends nothing."""
    path = scratch_path(spark, "monitor_append")
    rows = P.payload_to_monitor(D.events_payload(spark, sf_dir), D.MODEL_NAME)
    for _ in range(2):
        monitor_sink.monitor_append(spark, rows, path, [S.REQUEST_ID_FIELD, "record_pos"])
    return spark.read.parquet(path).drop(monitor_sink.DATE_COL)  # the date is the sink's partition key


@query
def score_and_log(spark, sf_dir):
    """1,000 events drawn with replacement, scored by a rule, logged as request/response JSON."""
    ev = _events(spark, sf_dir)
    sample = sampling.bootstrap_sample(spark, ev, ["event_id"], 1000, seed=42)
    feats = sample.select("draw_id", "ts", *[c.alias(n) for c, n in zip(D.event_record(), P.FEATURES)])
    scorer = lambda df: df.withColumn("prediction", (F.col("Height") > 50).cast("int"))
    return P.score_and_log(feats, scorer, F.concat(F.lit("draw-"), F.col("draw_id").cast("string")), F.col("ts"))


# --------------------------------------------------------------------------- monitoring

@query
def monitor_profile(spark, sf_dir):
    rows = D.monitor_rows(spark, sf_dir)
    return monitor.monitor_profile(rows, "ts", "model_name", ["value", "prediction"])


@query
def monitor_refresh(spark, sf_dir):
    """The profile after three refreshes: most rows of the first weeks, the other days, and last a late
    seventh of the first weeks' rows, delivered twice."""
    rows = D.monitor_rows(spark, sf_dir)
    first, late = F.col("ts") < F.lit("2024-01-18").cast("timestamp_ntz"), F.col("user_id") % 7 == 0
    path = scratch_path(spark, "monitor_state")
    for batch, part in enumerate((rows.filter(first & ~late), rows.filter(~first), rows.filter(first & late))):
        monitor_state.refresh_profile(spark, part, "ts", "model_name", ["value", "prediction"], path, batch)
    return monitor_state.refresh_profile(spark, part, "ts", "model_name", ["value", "prediction"], path, batch)


@query
def monitor_profile_categorical(spark, sf_dir):
    rows = D.monitor_rows(spark, sf_dir)
    return monitor.monitor_profile_categorical(rows, "ts", "model_name", ["segment", "prediction"])


@query
def monitor_prediction_mix(spark, sf_dir):
    return monitor.monitor_prediction_mix(D.monitor_rows(spark, sf_dir), "ts", "model_name", "prediction")


@query
def monitor_drift_categorical(spark, sf_dir):
    return monitor.monitor_drift_categorical(D.monitor_rows(spark, sf_dir), "ts", "model_name", "segment")


@query
def monitor_drift_numeric(spark, sf_dir):
    return monitor.monitor_drift_numeric(D.monitor_rows(spark, sf_dir), "ts", "model_name", "value")


@query
def monitor_quality(spark, sf_dir):
    rows = D.monitor_rows(spark, sf_dir).withColumn("y", (F.col("value") > 40).cast("int"))
    return monitor.monitor_quality(rows, "ts", "model_name", "y", "prediction")


@query
def monitor_drift_baseline(spark, sf_dir):
    """Each window against a fixed baseline table: the events of every third user."""
    rows = D.monitor_rows(spark, sf_dir)
    return monitor.monitor_drift_categorical(rows, "ts", "model_name", "segment", baseline=rows.filter(F.col("user_id") % 3 == 0))


@query
def monitor_drift_null_model(spark, sf_dir):
    """Events without a known type are a model of their own."""
    rows = D.monitor_rows(spark, sf_dir).withColumn("model_name", F.when(F.col("model_name") != "error", F.col("model_name")))
    return monitor.monitor_drift_numeric(rows, "ts", "model_name", "value")


@query
def train_test_tables(spark, sf_dir):
    """Clean, split exactly and save: the two tables as a training job finds them."""
    split = sampling.exact_split(clean.clean_table(D.raw_characters(spark, sf_dir)), ["Id"])
    paths = snapshots.save_train_test(split, scratch_path(spark, "train_test"), load_time=F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"))
    both = [spark.read.parquet(p).select("Id", F.lit(side).alias("side"), "update_timestamp_utc") for p, side in zip(paths, ("train", "test"))]
    return both[0].unionByName(both[1])


# --------------------------------------------------------------------------- metrics

@query
def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(D.scored_documents(spark, sf_dir), "y", "pred_a")


@query
def classification_metrics(spark, sf_dir):
    return metrics.classification_metrics(D.scored_documents(spark, sf_dir), "y", "pred_a")


@query
def log_loss(spark, sf_dir):
    return metrics.log_loss(D.scored_documents(spark, sf_dir), "y", "score_a").select(
        F.round("log_loss", 9).alias("log_loss"))


@query
def roc_auc(spark, sf_dir):
    return metrics.roc_auc(D.scored_documents(spark, sf_dir), "y", "score_a").select(F.round("roc_auc", 9).alias("roc_auc"))


@query
def pr_auc(spark, sf_dir):
    return metrics.pr_auc(D.scored_documents(spark, sf_dir), "y", "score_a").select(F.round("pr_auc", 9).alias("pr_auc"))


@query
def evaluate_scores(spark, sf_dir):
    """All metrics of stored scores, as (metric, value)."""
    return metrics.evaluate(D.scored_documents(spark, sf_dir), "y", "pred_a", "score_a")


@query
def champion_challenger(spark, sf_dir):
    return metrics.champion_challenger(D.scored_documents(spark, sf_dir), "y", "pred_a", "pred_b")


def _routed_documents(spark, sf_dir):
    routed = model.ab_route(D.scored_documents(spark, sf_dir), "doc_id")
    return routed.withColumns({
        "prediction": F.when(F.col("arm") == "A", F.col("pred_a")).otherwise(F.col("pred_b")),
        "model": F.concat(F.lit("Model "), F.col("arm"))})


@query
def ab_summary(spark, sf_dir):
    return model.ab_summary(_routed_documents(spark, sf_dir), "y")


@query
def ab_route(spark, sf_dir):
    return model.ab_route(table(spark, sf_dir, "customer"), "c_custkey").select("c_custkey", "arm")


# --------------------------------------------------------------------------- splits, samples

@query
def stable_split(spark, sf_dir):
    return sampling.stable_split(table(spark, sf_dir, "customer"), ["c_custkey"]).select("c_custkey", "split")


@query
def exact_split(spark, sf_dir):
    return sampling.exact_split(table(spark, sf_dir, "customer"), ["c_custkey"]).select("c_custkey", "split")


@query
def bootstrap_sample(spark, sf_dir):
    return sampling.bootstrap_sample(spark, table(spark, sf_dir, "customer"), ["c_custkey"], 1000, seed=42)


# --------------------------------------------------------------------------- coding

@query
def category_codes(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    train = orders.filter((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") != "5-LOW"))
    cols = ["o_orderpriority", "o_orderstatus"]
    codes = features.fit_category_codes(train, cols)
    return features.apply_category_codes(orders, codes, cols).select("o_orderkey", *cols)


# --------------------------------------------------------------------------- snapshots

@query
def snapshot_overwrite(spark, sf_dir):
    v1, v2 = D.orders_versions(spark, sf_dir)
    path = scratch_path(spark, "snapshot_overwrite")
    snapshots.snapshot_overwrite(v1, path, F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"))
    snapshots.snapshot_overwrite(v2, path, F.lit("2024-02-02 00:00:00").cast("timestamp_ntz"))
    return spark.read.parquet(path)


def _versioned(spark, sf_dir):
    v1, v2 = D.orders_versions(spark, sf_dir)
    path = scratch_path(spark, "versions")
    snapshots.write_version(v1, path, 1)
    snapshots.write_version(v2, path, 2)
    return path


@query
def read_version(spark, sf_dir):
    return snapshots.read_version(spark, _versioned(spark, sf_dir), 1)


@query
def latest_version(spark, sf_dir):
    path = _versioned(spark, sf_dir)
    v = snapshots.latest_version(spark, path)
    return snapshots.read_version(spark, path, v).agg(
        F.lit(v).cast("int").alias("latest_version"), F.count(F.lit(1)).alias("n_rows"))


@query
def change_feed(spark, sf_dir):
    v1, v2 = D.orders_versions(spark, sf_dir)
    return snapshots.change_feed(v1, v2, ["o_orderkey"])


@query
def change_history(spark, sf_dir):
    return snapshots.change_history(D.order_snapshots(spark, sf_dir), ["o_orderkey"])


@query
def run_loads(spark, sf_dir):
    """For every run, the last load of its table before it started."""
    used, loads = D.table_loads(spark, sf_dir)
    return asof.asof_join(used, loads, ["table_name"], "start_time", "load_time", ["load_id"])


# --------------------------------------------------------------------------- runs

@query
def best_descendants(spark, sf_dir):
    steps = runs.metric_steps(D.metric_rows(spark, sf_dir).filter(F.col("key") == "quantity"))
    return runs.best_descendants(D.nested_runs(spark, sf_dir), steps, ["o_orderpriority"])


@query
def run_search(spark, sf_dir):
    found = runs.run_search(D.runs_table(spark, sf_dir), D.metric_rows(spark, sf_dir), status="FINISHED",
                            started_after=F.lit("1995-01-01 00:00:00").cast("timestamp_ntz"),
                            name_like="%URGENT%", metric_conditions=[("quantity", ">", 25.0), ("discount", "<=", 0.06)],
                            tag_conditions=[("segment", "!=", "odd")], order_by=[F.col("run_name"), F.col("start_time")])
    return found.select("run_id", "run_name", "start_time", "status")


@query
def latest_per_model(spark, sf_dir):
    return runs.latest_per_model(table(spark, sf_dir, "part"), "p_brand", "p_partkey", ["p_name", "p_retailprice"])


@query
def metric_steps(spark, sf_dir):
    return runs.metric_steps(D.metric_rows(spark, sf_dir))


@query
def metrics_unnest(spark, sf_dir):
    return runs.metrics_unnest(D.runs_table(spark, sf_dir), "run_id", "metrics")


@query
def runs_json_scan(spark, sf_dir):
    """Runs exported as nested JSON (info / data maps), read back with a declared schema and unnested."""
    path = scratch_path(spark, "runs_json")
    runs_json.write_runs(D.runs_table(spark, sf_dir), path)
    back = runs_json.read_runs(spark, path)
    return runs.metrics_unnest(back.withColumn("run_id", F.col("run_id").cast("long")), "run_id", "metrics")


# --------------------------------------------------------------------------- synthesis

SYNTH_ROWS = 1000
SYNTH_BASE_ID = 1_700_000_000_000
DRIFT_WEIGHTS = {"click": 0.7, "view": 0.3}


@query
def synth_categorical(spark, sf_dir):
    return synth.synth_categorical(spark, _events(spark, sf_dir), "event_type", SYNTH_ROWS)


@query
def synth_numeric(spark, sf_dir):
    return synth.synth_numeric(spark, _events(spark, sf_dir), "value", SYNTH_ROWS, floor=0.1)


@query
def synth_timestamp(spark, sf_dir):
    return synth.synth_timestamp(spark, _events(spark, sf_dir), "ts", SYNTH_ROWS)


@query
def synth_bootstrap(spark, sf_dir):
    return synth.synth_bootstrap(spark, _events(spark, sf_dir), ["event_id"], "user_id", SYNTH_ROWS)


@query
def synth_ids(spark, sf_dir):
    """Ids for as many synthetic rows as the events table has."""
    n = _events(spark, sf_dir).count()
    return synth.synth_ids(spark, n, SYNTH_BASE_ID)


def _synth_events(spark, sf_dir, drift: bool):
    return synth.synth_table(spark, _events(spark, sf_dir), SYNTH_ROWS, numeric=["value"], floored=["value"],
                             categorical=["event_type"], timestamps=["ts"], bootstrap=["user_id"],
                             key_cols=["event_id"], base_id=SYNTH_BASE_ID, drift=drift, drift_scale=["value"],
                             drift_col="event_type", drift_weights=DRIFT_WEIGHTS)


@query
def synth_table(spark, sf_dir):
    return _synth_events(spark, sf_dir, drift=False)


@query
def inject_drift(spark, sf_dir):
    return _synth_events(spark, sf_dir, drift=True)


@query
def drift_demo(spark, sf_dir):
    """Normal then drifted synthetic rows as two consecutive windows; drift metrics of the second."""
    base = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    normal = _synth_events(spark, sf_dir, False).withColumn("ts", base + F.make_dt_interval(secs=F.col("row_id")))
    drifted = _synth_events(spark, sf_dir, True).withColumn(
        "ts", base + F.make_dt_interval(mins=F.lit(30), secs=F.col("row_id")))
    both = normal.unionByName(drifted).withColumn("model_name", F.lit("synthetic"))
    num = monitor.monitor_drift_numeric(both, "ts", "model_name", "value", granularity="30 minutes")
    cat = monitor.monitor_drift_categorical(both, "ts", "model_name", "event_type", granularity="30 minutes")
    out = num.join(cat, ["model", "window_start", "prev_start"]).filter(F.col("prev_start").isNotNull())
    return out.select("model", "window_start", "prev_start", "mean_shift", "ks", "total_variation", "psi",
                      ((F.col("ks") > 0.1) | (F.col("psi") > 0.2)).alias("drift_flag"))
