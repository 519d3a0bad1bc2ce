"""Stand-in inputs derived from the driver's test tables by fixed rules.

The reference works on a character table, a scoring log and model
predictions; the test tables have none of these, so each is derived here
from the given tables with deterministic rules (every row of the source
table is used; the rules only decide values).  ``oracle.py`` repeats the same
rules in DuckDB SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import schemas as S
from tidemark.operators import payload as P
from tidemark.plans.partitioning import spread
from tidemark.session import materialize
from tidemark.sources.tables import table

MODEL_NAME = "tidemark-model"
ORIGINS = ["Human", "Inhuman", "Human mutant", "Mutate", "Asgardian", "Alien", "Symbiote", "Robot",
           "Cosmic Being", "Magic user", "God", None]
IDENTITIES = ["Public", "Secret", None, "No Dual"]
GENDERS = ["Male", "Female", None, "Agender", "Male"]


def _pick(values: list, index: Column) -> Column:
    arr = F.array(*[F.lit(v).cast("string") for v in values])
    return F.element_at(arr, (index % len(values) + 1).cast("int"))


def raw_characters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw character table (D1 shape) from orders x customer x nation."""
    o, c, n = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    j = o.join(c, o.o_custkey == c.c_custkey).join(F.broadcast(n), c.c_nationkey == n.n_nationkey)  # nation: 25 rows
    variant = F.when(F.col("o_orderkey") % 100 == 0, F.lit("-variant")).otherwise(F.lit(""))
    return j.select(
        F.col("o_orderkey").alias("PageID"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(None))
         .otherwise(F.col("o_totalprice") / F.lit(100000.0)).alias("Height (m)"),
        F.col("c_acctbal").alias("Weight (kg)"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit(None))
         .otherwise(F.concat(F.col("n_name"), variant)).alias("Universe"),
        F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), F.col("c_mktsegment")).alias("Teams"),
        _pick(ORIGINS, F.col("o_orderkey")).alias("Origin"),
        _pick(IDENTITIES, F.col("o_custkey")).alias("Identity"),
        _pick(GENDERS, F.col("c_nationkey")).alias("Gender"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "Single").when(F.col("o_orderpriority") == "2-HIGH", "Married")
         .when(F.col("o_orderpriority") == "3-MEDIUM", "Widow").when(F.col("o_orderpriority") == "5-LOW", "Divorced")
         .alias("Marital Status"),
        F.when(F.col("o_orderstatus") == "F", "Alive").when(F.col("o_orderstatus") == "O", "Dead").alias("Alive"),
    )


def event_record(height: Column | None = None, weight: Column | None = None) -> list[Column]:
    """The ten request features of one event (numbers stay JSON numbers)."""
    uid, value = F.col("user_id"), F.col("value")
    return [
        height if height is not None else value,
        weight if weight is not None else uid.cast("double"),
        F.col("event_type"),
        F.when(uid % 3 == 0, "Public").when(uid % 3 == 1, "Secret"),
        F.when(value < 30, "Male").when(value < 60, "Female"),
        F.when(uid % 2 == 0, "Single").otherwise("Married"),
        (uid % 2).cast("int"),
        F.concat(F.lit("origin-"), (uid % 4).cast("string")),
        (value > 90).cast("int"),
        (value < 5).cast("int"),
    ]


def event_prediction() -> Column:
    return (F.col("value") > 50).cast("int")


def events_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scoring log (D5 shape) from ``events``, with the dirty cases every parser must meet:
    unparsable and empty requests, a wrong-typed field, two-record requests, the
    text-label response shape, unparsable and empty responses."""
    ev = spread(table(spark, sf_dir, "events"))  # JSON work per row: use every core
    et, bucket = F.col("event_type"), F.col("user_id") % 10
    one = P.build_request([event_record()])
    two = P.build_request([event_record(), event_record(F.col("value") + F.lit(1.0),
                                                         (F.col("user_id") + 1).cast("double"))])
    request = (F.when((et == "error") & (bucket == 1), F.lit("not json"))
               .when((et == "click") & (bucket == 2), F.lit('{"dataframe_records":[]}'))
               .when((et == "view") & (bucket == 0), F.regexp_replace(one, '"Height":[-0-9.E]+', '"Height":"x"'))
               .when(et == "signup", two)
               .otherwise(one))
    rid = F.concat(F.lit("req-"), F.col("event_id").cast("string"))
    p = event_prediction()
    response = (F.when(et == "error", P.build_label_response(F.array(p)))
                .when((et == "purchase") & (bucket == 3), F.lit("oops"))
                .when((et == "view") & (bucket == 4), F.lit('{"predictions":[]}'))
                .when(et == "signup", P.build_response(F.array(p, F.lit(1) - p), rid))
                .otherwise(P.build_response(F.array(p), rid)))
    log = ev.select(
        request.alias("request"), response.alias("response"), F.col("ts").alias("request_time"),
        rid.alias(S.REQUEST_ID_FIELD), F.floor(F.col("value") * 10).cast("long").alias("execution_duration_ms"))
    # The log is a stored table in a real deployment: materialise it (built on all cores), so
    # downstream predicates scan it instead of being pushed below the round-robin exchange.
    return materialize(log)


def monitor_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monitoring-table rows straight from ``events``: model = event type, prediction = value > 50."""
    ev = table(spark, sf_dir, "events")
    return ev.select("ts", F.col("event_type").alias("model_name"), event_prediction().alias("prediction"),
                     "value", "user_id", F.concat(F.lit("s"), (F.col("user_id") % 4).cast("string")).alias("segment"))


def scored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents with two fixed scoring rules (champion ``a``, challenger ``b``).

    Scores are rational functions of ``n_chars`` floored to 2 decimals, so ties
    occur and both engines compute bit-identical values.
    """
    lab, doc = table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents")
    j = lab.join(doc.select("doc_id", "n_chars", "lang", "source"), "doc_id")
    n = F.col("n_chars").cast("double")
    a = F.floor(F.lit(100.0) * n / (n + F.lit(1000.0))) / F.lit(100.0)
    b = F.floor(F.lit(100.0) * F.lit(1000.0) / (n + F.lit(1000.0))) / F.lit(100.0)
    return j.select("doc_id", F.col("quality").alias("y"), "n_chars", "lang", "source",
                    a.alias("score_a"), b.alias("score_b")).withColumns({
        "pred_a": (F.col("score_a") >= 0.5).cast("int"), "pred_b": (F.col("score_b") >= 0.5).cast("int")})


def orders_versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two versions of the orders table: v1 without pending orders; v2 without open
    orders and with urgent prices raised by 10%."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                              "o_orderpriority")
    v1 = o.filter(F.col("o_orderstatus") != "P")
    v2 = o.filter(F.col("o_orderstatus") != "O").withColumn(
        "o_totalprice", F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice") * F.lit(1.1))
        .otherwise(F.col("o_totalprice")))
    return v1, v2


def runs_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    status = (F.when(F.col("o_orderstatus") == "F", "FINISHED").when(F.col("o_orderstatus") == "O", "RUNNING")
              .otherwise("FAILED"))
    return o.select(F.col("o_orderkey").alias("run_id"), status.alias("status"),
                    F.col("o_orderdate").alias("start_time"), F.col("o_orderpriority").alias("run_name"),
                    F.create_map(F.lit("segment"), F.when(F.col("o_custkey") % 2 == 0, "even").otherwise("odd"))
                    .alias("tags"),
                    F.create_map(F.lit("totalprice"), F.col("o_totalprice"),
                                 F.lit("custkey"), F.col("o_custkey").cast("double")).alias("metrics"))


def metric_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("run_id"), F.inline(F.array(
        F.struct(F.lit("quantity").alias("key"), F.col("l_quantity").alias("value"), F.col("l_linenumber").alias("step")),
        F.struct(F.lit("discount").alias("key"), F.col("l_discount").alias("value"), F.col("l_linenumber").alias("step")))))


def order_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five versions of the orders table (labels 1, 2, 4, 7 and 8) whose orders vanish, return and change."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    v = F.col("_version")
    rows = o.withColumn("_version", F.explode(F.array(*[F.lit(n) for n in (1, 2, 4, 7, 8)])))
    away = (F.col("o_orderkey") % 9 == v) | ((F.col("o_custkey") % 5 == 0) & v.isin(2, 4))
    raised = (F.col("o_orderpriority") == "1-URGENT") & (v >= 4)
    return rows.filter(~away).withColumns({
        "o_totalprice": F.when(raised, F.col("o_totalprice") * F.lit(1.1)).otherwise(F.col("o_totalprice")),
        "o_orderstatus": F.when(~((F.col("o_orderkey") % 6 == 0) & (v == 7)), F.col("o_orderstatus"))})


def nested_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs in trees: a third of them in one binary tree under run 0, the others in chains of up to 21."""
    k = F.col("o_orderkey")
    j = F.floor(k / 3)
    parent = (F.when(k % 3 == 0, F.when(k > 0, 3 * F.floor((j - 1) / 2)))
              .when(j % 21 != 0, k - 3))
    return table(spark, sf_dir, "orders").select(k.alias("run_id"), parent.cast("long").alias("parent_run_id"), "o_orderpriority")


def loose_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON records of mixed shapes from orders: types that differ, fields that come and go, records that are none."""
    k, c = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    fields = [F.lit('{"id":'), k.cast("string"), F.lit(',"price":'),
              F.when((k % 10 == 0) & (F.col("o_orderstatus") == "O"), F.lit('"n/a"')).when(k % 10 == 1, F.concat(c, F.lit(".5"))).otherwise(c),
              F.when(k % 10 == 4, F.lit("")).otherwise(F.concat(F.lit(',"status":"'), F.col("o_orderstatus"), F.lit('"'))),
              F.when((k % 10 == 5) & (F.col("o_orderstatus") != "O"), F.lit(',"note":null')).when(k % 10 == 6, F.lit(',"tags":["a",1]')).otherwise(F.lit("")),
              F.when(F.col("o_orderstatus") == "O", F.lit(',"open":true')).otherwise(F.lit(',"rank":7')), F.lit("}")]
    record = F.when(k % 100 == 2, F.lit("oops")).when(k % 100 == 3, F.lit("[1]")).otherwise(F.concat(*fields))
    return table(spark, sf_dir, "orders").select(k.alias("record_id"), "o_orderstatus", record.alias("record"))


def table_loads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Runs and table loads with their times; one table holds a third of both."""
    name = lambda key, other: F.when(key % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("t"), (other % 20).cast("string")))
    used = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("run_id"), name(F.col("o_orderkey"), F.col("o_custkey")).alias("table_name"),
                                                 F.col("o_orderdate").alias("start_time"))
    loads = table(spark, sf_dir, "lineitem").select(name(F.col("l_orderkey"), F.col("l_suppkey")).alias("table_name"), F.col("l_shipdate").alias("load_time"),
                                                    (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("load_id"))
    return used, loads
