"""Histogram boosting of a yes/no classifier, one aggregate per tree level.

Features become bins once: a numeric column is cut at exact quantiles of its training values, a category
is a bin of its own.  Bin 0 holds missing values (and categories that training didn't see, as code -1), so nothing is
imputed: every split learns on which side missing values go.  A numeric split is a bin bound.  A categorical split is a
*set* of categories: they are ordered by gradient over (hessian + ``smooth``), where the best two sets are a cut of that order.

Trees grow level by level.  A level is one partial aggregate over (node, feature, bin) with the sums of gradient and hessian and the
row count; of two siblings only the smaller one is summed, the other is its parent less its sibling.  Gradients are
rounded to multiples of 2^-24 and summed as whole numbers, so the same rows give the same trees in whatever partitions and order
they come.  What reaches the driver are histograms: features x 256 bins for each node of one level,
whatever the number of rows.  Rows find their node by array lookups with the tree as data.  Scores are cached tree by tree, and every ``CUT`` trees a checkpoint in the shared folder ends the lineage.

Rows with a null label are not trained on.  Without training rows, or with one class only, the model is a constant.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.features import apply_category_codes, fit_category_codes
from tidemark.plans.ordered import grouped_running_totals
from tidemark.session import materialize

BINS = 256
UNIT = float(1 << 24)
CUT = 20


@dataclass(frozen=True)
class Settings:
    """``rate``, ``trees`` and ``depth`` default to the reference's own settings."""

    trees: int = 1000
    depth: int = 6
    rate: float = 0.01
    bins: int = 255
    min_rows: int = 20
    min_hessian: float = 1e-3
    ridge: float = 0.0
    smooth: float = 10.0


# --------------------------------------------------------------------------- bins


def numeric_edges(train: DataFrame, num_cols: Sequence[str], bins: int = BINS - 1) -> dict[str, list[float]]:
    """The smallest value of each bin per column: ``bins`` quantiles of the non-missing values at most, exact."""
    if not num_cols:
        return {}
    parts = ", ".join(f"'{c}', cast(`{c}` as double)" for c in num_cols)
    long = train.selectExpr(f"stack({len(num_cols)}, {parts}) as (column_name, v)").where("v IS NOT NULL AND NOT isnan(v)")
    hist = materialize(long.groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("c")))
    run = grouped_running_totals(hist, ["column_name"], "v", ["c"])
    place = F.floor((F.col("cum_c") - F.col("c")) * bins / F.col("tot_c"))
    edges = run.groupBy("column_name", place.alias("bin")).agg(F.min("v").alias("edge")).groupBy("column_name").agg(F.array_sort(F.collect_list("edge")).alias("edges"))
    found = {r.column_name: list(r.edges) for r in edges.collect()}
    return {c: found.get(c, []) for c in num_cols}


def numeric_bins(df: DataFrame, edges: dict[str, list[float]], out: dict[str, str]) -> DataFrame:
    """The number of edges at or below a value (1 at least), 0 where it is missing or training had no value."""
    cols = [c for c in edges if len(edges[c]) > 1]
    value = {c: F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in edges}
    splits = {c: [-float("inf"), *edges[c][1:], float("inf")] for c in cols}
    df = df.withColumns({out[c]: value[c] if c in cols else F.when(F.isnan(value[c]), 0).otherwise(len(edges[c])) for c in edges})
    if cols:
        cut = Bucketizer(splitsArray=[splits[c] for c in cols], inputCols=[out[c] for c in cols], outputCols=[f"{out[c]}__b" for c in cols], handleInvalid="keep")
        df = cut.transform(df)
        df = df.withColumns({out[c]: F.when(F.isnan(out[c]), 0).otherwise(F.col(f"{out[c]}__b") + 1).cast("int") for c in cols}).drop(*[f"{out[c]}__b" for c in cols])
    return df


# --------------------------------------------------------------------------- splits


@dataclass
class Split:
    feature: int
    left: np.ndarray  # for each bin, whether its rows go left
    gain: float
    left_rows: int


def _cuts(g: np.ndarray, h: np.ndarray, n: np.ndarray, order: np.ndarray, s: Settings) -> tuple[float, int, bool, int] | None:
    """The best cut of one feature's bins in ``order``: gain, how many bins go left, whether missing values do, and the rows on the left."""
    total_g, total_h, total_n = g.sum(), h.sum(), n.sum()
    best = None
    for missing_left in (True, False) if n[0] else (None,):
        gl = np.cumsum(g[order][:-1]) + (g[0] if missing_left else 0)
        hl = np.cumsum(h[order][:-1]) + (h[0] if missing_left else 0)
        nl = np.cumsum(n[order][:-1]) + (n[0] if missing_left else 0)
        if missing_left is False and len(order):  # everything known against missing
            gl, hl, nl = np.append(gl, g[order].sum()), np.append(hl, h[order].sum()), np.append(nl, n[order].sum())
        if not len(gl):
            continue
        gr, hr, nr = total_g - gl, total_h - hl, total_n - nl
        fine = (nl >= s.min_rows) & (nr >= s.min_rows) & (hl >= s.min_hessian * UNIT) & (hr >= s.min_hessian * UNIT)
        if not fine.any():
            continue
        a, b, c, d = gl / UNIT, hl / UNIT, gr / UNIT, hr / UNIT
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where(fine, a * a / (b + s.ridge) + c * c / (d + s.ridge), -np.inf)
        k = int(gain.argmax())
        if best is None or gain[k] > best[0]:
            side = bool(missing_left) if missing_left is not None else bool(nl[k] >= nr[k])
            best = (float(gain[k]), k + 1, side, int(nl[k]))
    return best


def best_split(hist: np.ndarray, categorical: Sequence[bool], s: Settings) -> Split | None:
    """``hist``: sums of gradient, hessian and rows by feature and bin.  Ties go to the earlier feature, missing values
    on the left, and fewer bins on the left."""
    found: Split | None = None
    whole = hist[:, 0].sum(axis=1) / UNIT
    for f, is_set in enumerate(categorical):
        g, h, n = hist[:, f]
        order = np.flatnonzero(n[1:]) + 1
        if is_set:
            order = order[np.argsort((g[order] / UNIT) / (h[order] / UNIT + s.smooth), kind="stable")]
        cut = _cuts(g, h, n, order, s)
        if cut is None:
            continue
        gain, k, missing_left, rows = cut
        gain -= whole[0] * whole[0] / (whole[1] + s.ridge)
        if gain > 0 and (found is None or gain > found.gain):
            left = np.zeros(BINS, bool)
            left[order[:k]] = True
            if not is_set and k < len(order):
                left[1 : order[k]] = True  # bins without rows here lie on the side of their neighbours below the cut
            elif not is_set:
                left[1:] = True
            left[0] = missing_left
            found = Split(f, left, gain, rows)
    return found


# --------------------------------------------------------------------------- trees


@dataclass
class Tree:
    """Nodes in heap order: children of k are 2k + 1 (left) and 2k + 2.  ``feature`` is -1 at leaves and unused places."""

    feature: np.ndarray
    left: np.ndarray
    gain: np.ndarray
    rows: np.ndarray
    value: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = 2 ** (depth + 1) - 1
        return cls(np.full(n, -1, np.int32), np.zeros((n, BINS), bool), np.zeros(n), np.zeros(n, np.int64), np.zeros(n))


def _literal(values: np.ndarray) -> Column:
    """An array as one folded literal: data of the plan, not part of the generated code."""
    kind = "double" if values.dtype.kind == "f" else "int"
    return F.split(F.lit(",".join(map(repr, values.tolist()))), ",").cast(f"array<{kind}>")


def _walk(df: DataFrame, tree: Tree, depth: int) -> DataFrame:
    """Adds ``node``, the place each row reaches in ``depth`` steps at most.

    One fold over the steps: the node is a lambda variable, so the expression stays as small at any depth (projections
    level by level would be merged by the optimizer and grow several times with each)."""
    inner = 2**depth - 1  # a node beyond has no entry, and stays
    feature, sides = _literal(tree.feature[:inner]), _literal(np.where(tree.left[:inner], 1, 2).ravel())

    def step(node: Column, _: Column) -> Column:
        on = F.get(feature, node)
        return F.when(on >= 0, 2 * node + F.get(sides, node * BINS + F.get("bins", on).cast("int") + 128)).otherwise(node)

    return df.withColumn("node", F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(0), step))


def _histograms(rows: DataFrame, nodes: Sequence[int], n_features: int) -> dict[int, np.ndarray]:
    """Sums of the rows in ``nodes``: one partial aggregate over (node, feature, bin)."""
    some = rows.where(F.array_contains(_literal(np.asarray(nodes, np.int32)), F.col("node")))
    long = some.select("node", "g", "h", F.posexplode("bins").alias("feature", "bin"))
    sums = long.groupBy("node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.count(F.lit(1)).alias("n")).toArrow()
    out = {k: np.zeros((3, n_features, BINS), np.int64) for k in nodes}
    node, feature, bin_ = (sums.column(c).to_numpy() for c in ("node", "feature", "bin"))
    for name, at in (("g", 0), ("h", 1), ("n", 2)):
        values = sums.column(name).to_numpy()
        for k in nodes:
            mine = node == k
            out[k][at, feature[mine], bin_[mine].astype(int) + 128] = values[mine]
    return out


def grow(rows: DataFrame, categorical: Sequence[bool], s: Settings) -> Tree:
    """One tree on ``rows`` (``bins``, ``g``, ``h``)."""
    tree = Tree.empty(s.depth)
    hists = _histograms(rows.withColumn("node", F.lit(0)), [0], len(categorical))
    for level in range(s.depth + 1):
        split: dict[int, Split] = {}
        for k, hist in hists.items():
            g, h, n = hist[:, 0].sum(axis=1)
            tree.rows[k] = n
            tree.value[k] = -s.rate * (g / UNIT) / (h / UNIT + s.ridge) if h or s.ridge else 0.0
            if level < s.depth and (found := best_split(hist, categorical, s)) is not None:
                split[k] = found
                tree.feature[k], tree.left[k], tree.gain[k] = found.feature, found.left, found.gain
        if not split:
            return tree
        smaller = {k: 2 * k + (1 if 2 * f.left_rows <= tree.rows[k] else 2) for k, f in split.items()}
        counted = _histograms(_walk(rows, tree, level + 1), sorted(smaller.values()), len(categorical))
        before, hists = hists, {}
        for k, child in smaller.items():
            hists[child], hists[4 * k + 3 - child] = counted[child], before[k] - counted[child]
    return tree


# --------------------------------------------------------------------------- the model


@dataclass
class BoostedModel:
    """Codes, edges and trees of a fit; ``start`` is the log odds before the first tree."""

    codes: DataFrame
    edges: dict[str, list[float]]
    cat_cols: list[str]
    num_cols: list[str]
    start: float
    trees: list[Tree]
    settings: Settings

    @property
    def features(self) -> list[str]:
        return [*self.cat_cols, *self.num_cols]

    def binned(self, df: DataFrame) -> DataFrame:
        """``df`` with ``bins``: a byte per feature, categories first."""
        return _binned(df, self.codes, self.edges, self.cat_cols, self.num_cols)

    def scored(self, df: DataFrame) -> DataFrame:
        """``df`` with ``margin`` (log odds), ``probability`` of class 1 and ``prediction``."""
        return self._probability(self.margins(df))

    def margins(self, df: DataFrame) -> DataFrame:
        """One pass over the rows; the trees are broadcast (32 bytes a node, bounded by the settings, not by the data)."""
        binned = self.binned(df)
        at = binned.columns.index("bins")
        schema = StructType([f for f in binned.schema.fields if f.name != "bins"]).add("margin", "double")
        empty = np.zeros((0, 1), np.int32)
        feature = np.stack([t.feature for t in self.trees]) if self.trees else empty
        sides = np.stack([np.packbits(t.left, axis=1) for t in self.trees]) if self.trees else empty
        value = np.stack([t.value for t in self.trees]) if self.trees else empty
        shared = df.sparkSession.sparkContext.broadcast((feature, sides, value))
        start, depth = self.start, self.settings.depth

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            feature, sides, value = shared.value
            for b in batches:
                bins = b.column(at).flatten().to_numpy().astype(np.int64).reshape(b.num_rows, -1) + 128
                margin, rows = np.full(b.num_rows, start), np.arange(b.num_rows)
                for f, left, v in zip(feature, sides, value):
                    node = np.zeros(b.num_rows, np.int64)
                    for _ in range(depth):
                        on = f[node]
                        bin_ = bins[rows, on]
                        step = 2 - ((left[node, bin_ >> 3] >> (7 - (bin_ & 7))) & 1)
                        node = np.where(on >= 0, 2 * node + step, node)
                    margin += v[node]
                columns = [c for k, c in enumerate(b.columns) if k != at]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(margin)], names=schema.names)

        return binned.mapInArrow(run, schema)

    @staticmethod
    def _probability(df: DataFrame) -> DataFrame:
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("margin")))
        return df.withColumn("probability", p).withColumn("prediction", (F.col("probability") > 0.5).cast("double"))

    def table(self, spark: SparkSession) -> DataFrame:
        """One row per node: tree, node, feature (null at leaves), gain, rows, rows' side of missing values, value."""
        rows = []
        for t, tree in enumerate(self.trees):
            for k in np.flatnonzero(tree.rows).tolist():
                f = int(tree.feature[k])
                rows.append((t, k, self.features[f] if f >= 0 else None, float(tree.gain[k]) if f >= 0 else None, int(tree.rows[k]),
                             bool(tree.left[k, 0]) if f >= 0 else None, float(tree.value[k])))
        return spark.createDataFrame(rows, "tree int, node int, feature string, gain double, n_rows bigint, missing_left boolean, value double")

    def save(self, path: str) -> None:
        """Codes, nodes and settings as tables under one folder."""
        spark = self.codes.sparkSession
        self.codes.write.mode("overwrite").parquet(f"{path}/codes")
        nodes = [(t, k, int(tree.feature[k]), bytearray(np.packbits(tree.left[k]).tobytes()), float(tree.gain[k]), int(tree.rows[k]), float(tree.value[k]))
                 for t, tree in enumerate(self.trees) for k in np.flatnonzero(tree.rows).tolist()]
        schema = "tree int, node int, feature int, sides binary, gain double, n_rows bigint, value double"
        spark.createDataFrame(nodes, schema).write.mode("overwrite").parquet(f"{path}/nodes")
        meta = (self.cat_cols, self.num_cols, [self.edges[c] for c in self.num_cols], self.start, len(self.trees), [(k, float(v)) for k, v in asdict(self.settings).items()])
        spark.createDataFrame([meta], "cat_cols array<string>, num_cols array<string>, edges array<array<double>>, start double, n_trees int, settings array<struct<name string, value double>>"
                              ).write.mode("overwrite").parquet(f"{path}/model")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedModel:
        meta = spark.read.parquet(f"{path}/model").first()
        kinds = {k: type(v) for k, v in asdict(Settings()).items()}
        settings = Settings(**{r["name"]: kinds[r["name"]](r["value"]) for r in meta.settings})
        trees = [Tree.empty(settings.depth) for _ in range(meta.n_trees)]
        for r in spark.read.parquet(f"{path}/nodes").toLocalIterator():
            t = trees[r.tree]
            t.feature[r.node], t.gain[r.node], t.rows[r.node], t.value[r.node] = r.feature, r.gain, r.n_rows, r.value
            t.left[r.node] = np.unpackbits(np.frombuffer(bytes(r.sides), np.uint8)).astype(bool)
        return cls(spark.read.parquet(f"{path}/codes"), dict(zip(meta.num_cols, map(list, meta.edges))), list(meta.cat_cols), list(meta.num_cols), meta.start, trees, settings)


def _binned(df: DataFrame, codes: DataFrame, edges: dict[str, list[float]], cat_cols: Sequence[str], num_cols: Sequence[str]) -> DataFrame:
    names = {c: f"{c}__bin" for c in [*cat_cols, *num_cols]}
    out = apply_category_codes(df, codes, cat_cols, suffix="__bin") if cat_cols else df
    out = numeric_bins(out, edges, names)
    # codes start at -1 for unknown; beyond the last bin categories share it
    cols = [F.least(F.col(names[c]) + 1, F.lit(BINS - 1)) for c in cat_cols] + [F.col(names[c]) for c in num_cols]
    return out.withColumn("bins", F.array(*[(c - 128).cast("tinyint") for c in cols])).drop(*names.values())


def train(df: DataFrame, cat_cols: Sequence[str], num_cols: Sequence[str], label: str, settings: Settings | None = None) -> BoostedModel:
    """Fit on the rows of ``df`` whose ``label`` (0 or 1) isn't null.  Missing values stay missing; at least one feature is needed."""
    s = settings or Settings()
    known = df.where(F.col(label).isNotNull())
    codes = materialize(fit_category_codes(known, cat_cols))
    edges = numeric_edges(known, num_cols, min(s.bins, BINS - 1))
    rows = materialize(_binned(known, codes, edges, cat_cols, num_cols).select("bins", F.col(label).cast("double").alias("y")))
    n, positive = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0.0))).first()
    share = min(max(positive / n, 1e-15), 1 - 1e-15) if n else 0.5
    start = float(np.log(share / (1 - share)))
    categorical = [True] * len(cat_cols) + [False] * len(num_cols)
    trees: list[Tree] = []
    state, kept = rows.withColumn("score", F.lit(start)), []
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("score")))
    whole = lambda x: F.floor(x * UNIT + 0.5)
    while len(trees) < s.trees and 0 < positive < n:
        tree = grow(state.select("bins", whole(p - F.col("y")).alias("g"), whole(p * (1 - p)).alias("h")), categorical, s)
        if tree.feature[0] < 0:  # no split helps, so none will in later rounds either
            break
        trees.append(tree)
        while len(kept) > 1:  # the state before this one has been read for the last time
            kept.pop(0).unpersist()
        state = _walk(state, tree, s.depth).select("bins", "y", (F.col("score") + F.get(_literal(tree.value), F.col("node"))).alias("score"))
        if len(trees) % CUT:
            kept.append(state.persist())
        else:
            state = materialize(state)
            while kept:
                kept.pop().unpersist()
    for state in kept:
        state.unpersist()
    return BoostedModel(codes, edges, list(cat_cols), list(num_cols), start, trees, s)
