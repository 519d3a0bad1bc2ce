"""Experiment runs and model versions as tables: search, latest per model, metric steps, nested runs."""

from __future__ import annotations

import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans.joins import lookup_join
from tidemark.session import materialize


def metric_steps(metrics: DataFrame, run_col: str = "run_id", key_col: str = "key", value_col: str = "value",
                 step_col: str = "step", time_col: str | None = None) -> DataFrame:
    """Latest value per (run, metric): the value logged at the highest step.

    Of values logged at the same step the one with the latest ``time_col``
    counts; without it, or at equal times, the larger value, so the result
    never depends on row order.  ``max`` of the struct is a partial aggregate,
    so a run with millions of steps does not gather its rows in one place.
    """
    times = [F.col(time_col).alias("t")] if time_col else []
    top = F.max(F.struct(F.col(step_col).alias("s"), *times, F.col(value_col).alias("v"))).alias("_top")
    return metrics.groupBy(run_col, key_col).agg(top).select(
        run_col, key_col, F.col("_top.v").alias(value_col), F.col("_top.s").alias(step_col))


COMPARE = {"=": operator.eq, "!=": operator.ne, ">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le}


def run_search(runs: DataFrame, metrics: DataFrame | None = None, status: str | None = None,
               started_after=None, name_like: str | None = None,
               metric_conditions: Sequence[tuple[str, str, float]] = (),
               tag_conditions: Sequence[tuple[str, str, str]] = (),
               param_conditions: Sequence[tuple[str, str, str]] = (),
               order_by: Sequence[Column | str] | None = None, run_col: str = "run_id") -> DataFrame:
    """Filter runs like a tracking-server search string; newest first unless ``order_by`` says otherwise.

    Conditions are (key, operator, value) with =, !=, <, <=, > or >= and must
    all hold.  Metric conditions use each run's latest value: one aggregate
    marks the runs that meet all of them, and a ``left_semi`` join keeps those,
    so runs are never duplicated by their metric rows.  ``tags`` and ``params``
    are map columns; a run without the key meets only ``!=``.
    """
    out = runs
    if status is not None:
        out = out.filter(F.col("status") == status)
    if started_after is not None:
        out = out.filter(F.col("start_time") > F.lit(started_after))
    if name_like is not None:
        out = out.filter(F.col("run_name").like(name_like))
    for column, conditions in (("tags", tag_conditions), ("params", param_conditions)):
        for key, op, value in conditions:
            held = COMPARE[op](F.col(column)[key], F.lit(value))
            out = out.filter(F.coalesce(held, F.lit(op == "!=")))
    if metric_conditions and metrics is not None:
        latest = metric_steps(metrics, run_col)
        met = [F.max(F.when(F.col("key") == key, COMPARE[op](F.col("value"), F.lit(value)))).alias(f"_c{i}")
               for i, (key, op, value) in enumerate(metric_conditions)]
        good = latest.groupBy(run_col).agg(*met)
        for i in range(len(met)):
            good = good.filter(F.col(f"_c{i}"))
        out = out.join(good.select(run_col), run_col, "left_semi")
    return out.orderBy(*(order_by or [F.col("start_time").desc()]), F.col(run_col))


def latest_per_model(versions: DataFrame, model_col: str, version_col: str,
                     carry: Sequence[str] = ()) -> DataFrame:
    """The newest version of each model, with chosen columns of that version (``max_by``)."""
    aggs = [F.max(version_col).alias("latest_version")]
    aggs += [F.max_by(c, version_col).alias(c) for c in carry]
    return versions.groupBy(model_col).agg(*aggs)


def metrics_unnest(runs: DataFrame, run_col: str, map_col: str) -> DataFrame:
    """One row per (run, metric) from a map column of logged metrics."""
    return runs.select(run_col, F.explode(F.col(map_col)).alias("key", "value"))


def input_dataset(inputs: DataFrame, run_id, context: str, run_col: str = "run_id") -> DataFrame:
    """The dataset a run logged under ``context`` ("training" / "testing"); at most one row."""
    return inputs.filter((F.col(run_col) == F.lit(run_id)) & (F.col("context") == context)).limit(1)


def run_roots(runs: DataFrame, run_col: str = "run_id", parent_col: str = "parent_run_id") -> DataFrame:
    """(run, ``root``, ``depth``) of nested runs, however deep.

    Pointer doubling: every run points at its parent, and each round replaces the pointer by what its target points at,
    so a tree of depth d takes about log2(d) rounds.  Runs that have reached a root leave the rounds, so a root with a
    third of all runs is no join key.  A parent that is not in the table makes its child a root.  Runs on a cycle, or
    below one, have no root: ``root`` and ``depth`` are null.  Run ids are unique.
    """
    run = F.col(run_col).alias("run")
    ids = runs.select(run_col).filter(F.col(run_col).isNotNull()).select(F.col(run_col).alias("_parent"), F.lit(True).alias("_known"))
    linked = runs.select(run, F.col(parent_col).alias("_parent")).join(ids, "_parent", "left")
    child = F.col("_known").isNotNull()
    state = materialize(linked.select("run", F.when(child, F.col("_parent")).otherwise(F.col("run")).alias("root"),
                                      child.cast("long").alias("depth"), (~child).alias("done")))
    rounds = max(state.count(), 1).bit_length() + 1
    finished, open_ = state.filter("done"), state.filter("NOT done")
    for _ in range(rounds):
        targets = state.select(F.col("run").alias("root"), F.col("root").alias("_to"), F.col("depth").alias("_hops"), F.col("done").alias("_end"))
        state = materialize(lookup_join(open_, targets.join(open_.select("root").distinct(), "root", "left_semi"), "root").select(
            "run", F.col("_to").alias("root"), (F.col("depth") + F.col("_hops")).alias("depth"), F.col("_end").alias("done"))
            .unionByName(finished))
        finished, open_ = state.filter("done"), state.filter("NOT done")
        if open_.isEmpty():
            break
    placed = F.col("done")
    return state.select(F.col("run").alias(run_col), F.when(placed, F.col("root")).alias("root"), F.when(placed, F.col("depth")).alias("depth"))


def best_descendants(runs: DataFrame, values: DataFrame, carry: Sequence[str] = (), run_col: str = "run_id",
                     parent_col: str = "parent_run_id", value_col: str = "value", largest: bool = True) -> DataFrame:
    """Per root: ``n_runs`` (itself included), ``max_depth``, and its best descendant with value and ``carry`` columns.

    ``values`` has one value per run (``metric_steps``).  Ties go to the smallest run; null and NaN values never win. A
    root without a valued descendant has nulls.  The best one is a ``max`` of structs, a partial aggregate.
    """
    placed = run_roots(runs, run_col, parent_col).filter(F.col("root").isNotNull())
    rows = placed.join(runs.select(run_col, *carry), run_col).join(values.select(run_col, F.col(value_col).alias("_value")), run_col, "left")
    valued = (F.col("depth") > 0) & F.col("_value").isNotNull() & ~F.isnan(F.col("_value").cast("double"))
    kept = F.struct(F.col(run_col).alias("run"), F.col("_value").alias("value"), *[F.col(c) for c in carry])
    top = rows.filter(valued).groupBy("root", "_value").agg(F.min_by(kept, run_col).alias("_kept"))
    best = top.groupBy("root").agg((F.max_by if largest else F.min_by)("_kept", "_value").alias("_best"))
    sizes = rows.groupBy("root").agg(F.count(F.lit(1)).alias("n_runs"), F.max("depth").alias("max_depth"))
    return sizes.join(best, "root", "left").select(
        "root", "n_runs", "max_depth", F.col("_best.run").alias("best_run"), F.col("_best.value").alias("best_value"),
        *[F.col(f"_best.{c}").alias(c) for c in carry])
