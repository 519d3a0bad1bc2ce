"""Idempotent append into the monitoring table, and the full monitor refresh.

Re-running a refresh over the whole payload log must not double the table:
only rows whose ``(request id, record position)`` is not yet stored are
appended.  The table is partitioned by date, and the anti join reads only the
dates the incoming batch covers, so the check does not scan the whole history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tidemark.functions import schemas as S
from tidemark.operators import payload as P
from tidemark.plans.joins import null_safe_join
from tidemark.session import materialize
from tidemark.sources.tables import read_target, write_target

DATE_COL = "date"
KEYS = (S.REQUEST_ID_FIELD, "record_pos")


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None where there is none yet; any other fault is raised."""
    try:
        return read_target(spark, path)
    except AnalysisException as fault:
        if fault.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "TABLE_OR_VIEW_NOT_FOUND"):
            return None
        raise


def monitor_append(spark: SparkSession, rows: DataFrame, path: str, key_cols: Sequence[str] = KEYS,
                   time_col: str = "timestamp") -> int:
    """Append unseen rows, each key once; returns how many were appended.

    Repeated keys inside the batch are stored once.  Rows with a null key can't
    be told apart by it and are compared as whole rows; null times equal each
    other.  So a refresh over the same log appends nothing.  The batch is
    written once to the shared scratch folder, and only the date partitions
    that occur in it (one value per day reaches the driver) are read from the
    stored table.  The write goes through the ``rebalance`` hint on the date:
    each task writes few date folders, and AQE splits a busy day over several
    tasks.
    """
    keys, named = list(key_cols), sorted(rows.columns)
    unknown = F.lit(False)
    for k in keys:
        unknown = unknown | F.col(k).isNull()
    whole_row = F.when(unknown, F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in named]))
    dated = rows.withColumns({DATE_COL: F.to_date(F.col(time_col)), "_row": whole_row})
    batch = materialize(dated.dropDuplicates([*keys, "_row"]))
    stored = _stored(spark, path)
    if stored is not None:
        days = [r[0] for r in batch.select(DATE_COL).distinct().collect()]
        there = F.col(DATE_COL).isin([d for d in days if d is not None])
        if None in days:
            there = there | F.col(DATE_COL).isNull()
        mine = stored.filter(there).withColumn("_row", whole_row).select(*keys, "_row")
        batch = null_safe_join(batch, mine, [*keys, "_row"], "left_anti")
    balanced = batch.drop("_row").hint("rebalance", DATE_COL)
    seen = Observation("monitor_append")
    write_target(balanced.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").partitionBy(DATE_COL), path)
    return int(seen.get.get("n", 0) or 0)


def refresh_monitor(spark: SparkSession, payload: DataFrame, path: str, model_name: str,
                    align: bool = False) -> dict[str, int] | None:
    """Payload log -> monitoring table: the reference's whole refresh, made idempotent.

    Returns the stage counts (rows read, records exploded, records with a
    prediction, rows kept - one aggregate pass, ``payload.stage_counts``) and
    the rows appended (counted by ``observe`` in the write itself), or None
    when the payload is empty.
    """
    counts = P.stage_counts(payload).first().asDict()
    if not counts["n_read"]:
        return None
    rows = P.payload_to_monitor(payload, model_name, align=align)
    counts["n_appended"] = monitor_append(spark, rows, path)
    return {k: int(v or 0) for k, v in counts.items()}
