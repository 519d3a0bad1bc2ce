"""Registered MLlib queries (rows-only checks: learners are not bit-reproducible across engines).

Documents with labels stand in for the character table: ``quality`` is the
target, ``n_chars`` numeric, ``lang`` and ``source`` categorical.  Train and
test come from the exact 80/20 split.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidemark.operators import boosting, features, model as Mo
from tidemark.operators.sampling import exact_split
from tidemark.plans import standins as D
from tidemark.plans.queries import query
from tidemark.session import materialize, scratch_path

CAT = ["lang", "source"]
NUM = ["n_chars"]
LABEL = "y"
SMALL = {"maxIter": 10, "maxDepth": 3, "stepSize": 0.1}


def _split(spark, sf_dir):
    docs = D.scored_documents(spark, sf_dir).select("doc_id", LABEL, *NUM, *CAT)
    split = exact_split(docs, ["doc_id"], seed=42, test_fraction=0.2)
    return split.filter(F.col("split") == "train").drop("split"), split.filter(F.col("split") == "test").drop("split")


@query
def feature_vector(spark, sf_dir):
    """All documents with the codes of the training side, where one source was not yet known: it codes to -1."""
    train, test = _split(spark, sf_dir)
    codes = features.fit_category_codes(train.filter(F.col("source") != "src1"), CAT)
    coded = features.apply_category_codes(train.unionByName(test), codes, CAT, suffix="__code")
    vec = features.feature_vector(coded, [f"{c}__code" for c in CAT], NUM)
    arr = vector_to_array("features")
    slots = [f"{c}__code" for c in CAT] + NUM  # assembler order: codes first, then numeric columns
    return vec.select("doc_id", *[arr[i].alias(f"f_{name}") for i, name in enumerate(slots)])


@query
def train_classifier(spark, sf_dir):
    """Trees of the fitted ensemble: index, weight, node count."""
    train, _ = _split(spark, sf_dir)
    fitted = Mo.train_classifier(train, CAT, NUM, LABEL, SMALL)
    gbt = fitted.pipeline.stages[-1]
    rows = [(i, float(w), int(t.numNodes)) for i, (w, t) in enumerate(zip(gbt.treeWeights, gbt.trees))]
    return spark.createDataFrame(rows, "tree int, weight double, num_nodes int")


@query
def train_stump(spark, sf_dir):
    """One tree of depth one on a yes/no feature: its two leaf values are plain averages."""
    train, _ = _split(spark, sf_dir)
    train = train.withColumn("is_en", (F.col("lang") == "en").cast("int"))
    fitted = Mo.train_classifier(train, [], ["is_en"], LABEL, {"maxIter": 1, "maxDepth": 1})
    scored = fitted.pipeline.transform(Mo.with_missing_flags(fitted.prepare(train), ["is_en"]))
    return scored.select("is_en", F.round(vector_to_array("rawPrediction")[1], 9).alias("leaf_value")).distinct()


@query
def batch_score(spark, sf_dir):
    train, test = _split(spark, sf_dir)
    fitted = Mo.train_classifier(train, CAT, NUM, LABEL, SMALL)
    return Mo.batch_score(fitted, test, keep=["doc_id"], text_label=True)


@query
def evaluate_model(spark, sf_dir):
    train, test = _split(spark, sf_dir)
    fitted = Mo.train_classifier(train, CAT, NUM, LABEL, SMALL)
    return Mo.evaluate_model(fitted, test, LABEL)


@query
def ab_score(spark, sf_dir):
    train, test = _split(spark, sf_dir)
    a = Mo.train_classifier(train, CAT, NUM, LABEL, {"maxIter": 5, "maxDepth": 2, "stepSize": 0.1})
    b = Mo.train_classifier(train, CAT, NUM, LABEL, {"maxIter": 5, "maxDepth": 4, "stepSize": 0.1})
    return Mo.ab_score(a, b, test, "doc_id", keep=[LABEL])


def _with_gaps(df):
    """Lengths and languages that are missing by a fixed rule, and are left so."""
    return df.withColumns({"n_chars": F.when(F.col("doc_id") % 11 != 0, F.col("n_chars")), "lang": F.when(F.col("doc_id") % 7 != 0, F.col("lang"))})


@query
def boosted_trees(spark, sf_dir):
    """Every node of two boosted trees of depth two: split, gain, rows, side of missing values, value."""
    train, _ = _split(spark, sf_dir)
    fitted = boosting.train(_with_gaps(train), CAT, NUM, LABEL, boosting.Settings(trees=2, depth=2, rate=0.1))
    return fitted.table(spark).withColumns({"gain": F.round("gain", 6), "value": F.round("value", 9)})


@query
def param_sweep(spark, sf_dir):
    train, _ = _split(spark, sf_dir)
    return Mo.param_sweep(train, CAT, NUM, LABEL, {"maxDepth": [2, 3], "maxIter": [5]}, parallelism=2)


@query
def batch_score_check(spark, sf_dir):
    """Every test document scored once, with a label text and a class that agree with the probability."""
    train, test = _split(spark, sf_dir)
    scored = Mo.batch_score(Mo.train_classifier(train, CAT, NUM, LABEL, SMALL), test, keep=["doc_id"], text_label=True)
    text = F.when(F.col("prediction") == 1, "alive").otherwise("dead")
    return scored.select("doc_id", ((F.col("label_text") == text) & ((F.col("probability") > 0.5) == (F.col("prediction") == 1))).alias("consistent"))


@query
def ab_score_check(spark, sf_dir):
    """The arm that scored each test document."""
    return ab_score(spark, sf_dir).select("doc_id", "model")


@query
def model_roundtrip(spark, sf_dir):
    """Fit on a stored table, save, overwrite that table, load and score: the same as before."""
    train, test = _split(spark, sf_dir)
    path = scratch_path(spark, "train_table")
    train.write.parquet(path)
    fitted = Mo.train_classifier(spark.read.parquet(path), CAT, NUM, LABEL, SMALL)
    before = materialize(Mo.batch_score(fitted, test, keep=["doc_id"]))
    fitted.save(f"{path}-model")
    train.withColumn("lang", F.lit("aa")).write.mode("overwrite").parquet(path)
    after = Mo.batch_score(Mo.TrainedModel.load(spark, f"{path}-model"), test, keep=["doc_id"]).withColumnRenamed("probability", "later")
    return before.join(after.select("doc_id", "later"), "doc_id").select("doc_id", (F.col("probability") == F.col("later")).alias("same"))
