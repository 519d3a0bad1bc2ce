"""Training, scoring, evaluation and A/B routing with MLlib.

Training runs on the executors (``GBTClassifier``); nothing is collected to
the driver.  Category codes come from ``features.fit_category_codes`` so
unseen values get -1; numeric nulls are imputed with the training median
(MLlib trees take no missing values) and flagged.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.exprs import md5_parity_arm
from tidemark.operators import metrics as M
from tidemark.operators.features import apply_category_codes, fit_category_codes
from tidemark.session import materialize

# Reference hyper-parameters: learning rate 0.01, 1000 trees, depth 6.
REFERENCE_PARAMS = {"stepSize": 0.01, "maxIter": 1000, "maxDepth": 6}


@dataclass
class TrainedModel:
    codes: DataFrame
    pipeline: PipelineModel
    cat_cols: list[str]
    num_cols: list[str]

    def prepare(self, df: DataFrame) -> DataFrame:
        return _prepare(df, self.codes, self.cat_cols, self.num_cols)

    def save(self, path: str) -> None:
        """Pipeline, codes and column roles under one folder, for a scoring job to ``load``."""
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        self.codes.write.mode("overwrite").parquet(f"{path}/codes")
        spark = self.codes.sparkSession
        spark.createDataFrame([(self.cat_cols, self.num_cols)], "cat_cols array<string>, num_cols array<string>").write.mode(
            "overwrite").parquet(f"{path}/roles")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TrainedModel:
        roles = spark.read.parquet(f"{path}/roles").first()
        return cls(spark.read.parquet(f"{path}/codes"), PipelineModel.load(f"{path}/pipeline"), list(roles["cat_cols"]), list(roles["num_cols"]))


def _prepare(df: DataFrame, codes: DataFrame, cat_cols: Sequence[str], num_cols: Sequence[str]) -> DataFrame:
    coded = apply_category_codes(df, codes, cat_cols, suffix="__code")
    return coded.withColumns({f"{c}__num": F.col(c).cast("double") for c in num_cols})


def build_estimator(cat_cols: Sequence[str], num_cols: Sequence[str], label: str, params: dict,
                    seed: int = 42) -> Pipeline:
    num_in = [f"{c}__num" for c in num_cols]
    num_out = [f"{c}__imp" for c in num_cols]
    imputer = Imputer(inputCols=num_in, outputCols=num_out, strategy="median")
    assembler = VectorAssembler(inputCols=[f"{c}__code" for c in cat_cols] + num_out + [f"{c}__miss" for c in num_cols],
                                outputCol="features", handleInvalid="keep")
    gbt = GBTClassifier(labelCol=label, featuresCol="features", seed=seed, **params)
    return Pipeline(stages=[imputer, assembler, gbt])


def with_missing_flags(df: DataFrame, num_cols: Sequence[str]) -> DataFrame:
    return df.withColumns({f"{c}__miss": F.col(f"{c}__num").isNull().cast("double") for c in num_cols})


def train_classifier(train: DataFrame, cat_cols: Sequence[str], num_cols: Sequence[str], label: str,
                     params: dict | None = None, seed: int = 42) -> TrainedModel:
    # frozen: the codes of a fitted model don't change with the training table
    codes = materialize(fit_category_codes(train, cat_cols))
    prepared = with_missing_flags(_prepare(train, codes, cat_cols, num_cols), num_cols)
    pipe = build_estimator(cat_cols, num_cols, label, params or REFERENCE_PARAMS, seed)
    return TrainedModel(codes, pipe.fit(prepared.withColumn(label, F.col(label).cast("double"))),
                        list(cat_cols), list(num_cols))


def batch_score(model: TrainedModel, df: DataFrame, keep: Sequence[str] = (), text_label: bool = False) -> DataFrame:
    """``prediction`` (int) and ``probability`` of class 1; optional ``label_text``."""
    prepared = with_missing_flags(model.prepare(df), model.num_cols)
    scored = model.pipeline.transform(prepared)
    out = scored.select(*keep, F.col("prediction").cast("int").alias("prediction"),
                        vector_to_array("probability")[1].alias("probability"))
    if text_label:
        out = out.withColumn("label_text", F.when(F.col("prediction") == 1, "alive").otherwise("dead"))
    return out


def evaluate_model(model: TrainedModel, test: DataFrame, label: str) -> DataFrame:
    scored = batch_score(model, test, keep=[label])
    return M.evaluate(scored, label, "prediction", "probability")


def ab_route(df: DataFrame, id_col: str, out_col: str = "arm") -> DataFrame:
    """Arm A when md5(id) read as a number is odd, else B - the same id always lands in the same arm."""
    return df.withColumn(out_col, md5_parity_arm(id_col))


def ab_score(model_a: TrainedModel, model_b: TrainedModel, df: DataFrame, id_col: str,
             keep: Sequence[str] = ()) -> DataFrame:
    """Each row is scored by its own arm's model (not the batch's first row).

    The routed halves are scored separately and unioned, so each model only
    sees its own rows.
    """
    routed = ab_route(df, id_col)
    cols = [id_col, *keep]
    a = batch_score(model_a, routed.filter(F.col("arm") == "A"), keep=cols).withColumn("model", F.lit("Model A"))
    b = batch_score(model_b, routed.filter(F.col("arm") == "B"), keep=cols).withColumn("model", F.lit("Model B"))
    return a.unionByName(b)


def ab_summary(scored: DataFrame, label: str, prediction: str = "prediction", arm: str = "model") -> DataFrame:
    """Per arm: rows, share of positive predictions, F1."""
    share = F.avg(F.col(prediction).cast("double")).alias("positive_share")
    cm = M.rates(M.confusion_matrix(scored, label, prediction, by=[arm], also=[share]))  # one scan
    return cm.select(arm, F.col("n").alias("n_rows"), "positive_share", "f1")


def param_sweep(train: DataFrame, cat_cols: Sequence[str], num_cols: Sequence[str], label: str,
                grid: dict[str, list], seed: int = 42, parallelism: int = 2) -> DataFrame:
    """Train one model per parameter combination; area under ROC on a held-out part."""
    codes = fit_category_codes(train, cat_cols)
    prepared = with_missing_flags(_prepare(train, codes, cat_cols, num_cols), num_cols).withColumn(
        label, F.col(label).cast("double"))
    pipe = build_estimator(cat_cols, num_cols, label, {}, seed)
    gbt = pipe.getStages()[-1]
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(gbt.getParam(name), values)
    maps = builder.build()
    tvs = TrainValidationSplit(estimator=pipe, estimatorParamMaps=maps, trainRatio=0.8, seed=seed,
                               parallelism=parallelism,
                               evaluator=BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC"))
    fitted = tvs.fit(prepared)
    spark = train.sparkSession
    rows = [({p.name: float(v) for p, v in m.items()}, float(metric)) for m, metric in zip(maps, fitted.validationMetrics)]
    return spark.createDataFrame([(str(sorted(p.items())), m) for p, m in rows], "params string, roc_auc double")
