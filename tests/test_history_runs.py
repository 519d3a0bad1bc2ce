"""Change histories, nested runs, as-of joins and learned signatures against plain versions."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions import schemas as S
from tidemark.operators import asof, payload as P, runs, signature
from tidemark.sources import snapshots


def _rows(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


# --------------------------------------------------------------------------- change history

def _snapshots(seed):
    draw = random.Random(seed)
    return {v: {k: draw.choice([None, "x", "y"]) for k in [None, *range(6)] if draw.random() < 0.6} for v in (3, 4, 9, 12, 20)}


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("from_start", [False, True])
def test_history_equals_plain_comparison(spark, seed, from_start):
    versions = _snapshots(seed)
    want, before = [], ({} if from_start else None)
    for v, now in versions.items():
        for k in set(before or {}) | set(now) if before is not None else ():
            if k not in before:
                want.append((k, now[k], "insert", v))
            elif k not in now:
                want.append((k, before[k], "delete", v))
            elif now[k] != before[k]:
                want += [(k, before[k], "update_preimage", v), (k, now[k], "update_postimage", v)]
        before = now
    df = spark.createDataFrame([(v, k, x) for v, now in versions.items() for k, x in now.items()], "_version int, k int, x string")
    got = snapshots.change_history(df, ["k"], from_start=from_start)
    assert got.columns == ["k", "x", "_change_type", "_version"]
    assert _rows(got) == sorted(map(str, want))


def test_history_of_one_version_and_of_none(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "_version int, k int, x string")
    assert snapshots.change_history(df, ["k"]).count() == 0
    assert snapshots.change_history(df, ["k"], from_start=True).count() == 2
    assert snapshots.change_history(df.limit(0), ["k"], from_start=True).count() == 0


# --------------------------------------------------------------------------- nested runs

def test_roots_of_a_long_chain_a_wide_root_and_a_cycle(spark):
    chain = [(i, i - 1 if i else None) for i in range(70)]
    wide = [(1000 + i, 1000 if i else None) for i in range(300)]
    cycle = [(5001, 5002), (5002, 5003), (5003, 5001), (5004, 5001)]
    lost = [(6001, 999_999), (6002, 6001), (6003, 6003 + 10)]
    df = spark.createDataFrame(chain + wide + cycle + lost, "run_id long, parent_run_id long")
    got = {r["run_id"]: (r["root"], r["depth"]) for r in runs.run_roots(df).collect()}
    want = {i: (0, i) for i, _ in chain} | {k: (1000, int(k > 1000)) for k, _ in wide} | {k: (None, None) for k, _ in cycle}
    assert got == want | {6001: (6001, 0), 6002: (6001, 1), 6003: (6003, 0)}


def test_best_descendant_ties_nulls_and_nan(spark):
    df = spark.createDataFrame([(1, None, "r"), (2, 1, "a"), (3, 2, "b"), (4, 1, "c"), (5, 1, "d"), (6, None, "lone"), (7, 6, "none")],
                               "run_id long, parent_run_id long, p string")
    values = spark.createDataFrame([(1, 99.0), (2, 5.0), (3, 7.0), (4, 7.0), (5, float("nan")), (7, None)], "run_id long, value double")
    top = {r["root"]: tuple(r)[1:] for r in runs.best_descendants(df, values, ["p"]).collect()}
    assert top == {1: (5, 2, 3, 7.0, "b"), 6: (2, 1, None, None, None)}
    low = {r["root"]: r["best_run"] for r in runs.best_descendants(df, values, ["p"], largest=False).collect()}
    assert low == {1: 2, 6: None}
    assert runs.best_descendants(df.limit(0), values, ["p"]).count() == 0


# --------------------------------------------------------------------------- as-of join

@pytest.mark.parametrize("seed", range(3))
def test_asof_join_equals_plain_search(spark, seed):
    draw = random.Random(seed)
    key = lambda: draw.choice(["hot"] * 6 + ["a", "b", None])
    time = lambda: draw.choice([None, *range(40)])
    used = [(i, key(), time()) for i in range(300)]
    loads = [(key(), time(), draw.randrange(1000)) for _ in range(60)]
    want = []
    for i, k, t in used:
        seen = [(at, n) for name, at, n in loads if name == k and at is not None and t is not None and at <= t]
        want.append((i, k, t, *(max(seen) if seen else (None, None))))
    got = asof.asof_join(spark.createDataFrame(used, "run long, name string, start int").repartition(3),
                         spark.createDataFrame(loads, "name string, loaded int, load_id int").repartition(3), ["name"], "start", "loaded", ["load_id"])
    assert got.columns == ["run", "name", "start", "loaded", "load_id"]
    assert _rows(got) == sorted(map(str, want))


def test_asof_join_with_an_empty_side(spark):
    used = spark.createDataFrame([(1, "a", 5)], "run long, name string, start int")
    loads = spark.createDataFrame([("a", 5, 1)], "name string, loaded int, load_id int")
    assert _rows(asof.asof_join(used, loads.limit(0), ["name"], "start", "loaded", ["load_id"])) == ["(1, 'a', 5, None, None)"]
    assert asof.asof_join(used.limit(0), loads, ["name"], "start", "loaded", ["load_id"]).count() == 0


# --------------------------------------------------------------------------- signatures

RECORDS = ['{"a": 1, "b": "x", "c": null}', '{"a": 2.5, "b": 3, "d": {"e": 1}}', '{"a": 1e300, "b": true, "odd name.x`": [1]}', "{}", "[1]", "7",
           "null", None, "broken{", '{"a": 1, "a": 2}']


def test_signature_of_mixed_records(spark):
    got = {r["field"]: tuple(r)[1:] for r in signature.learn_signature(spark.createDataFrame([(r,) for r in RECORDS], "j string"), "j").collect()}
    assert got == {"a": ("double", 3, 0, 4, False), "b": ("mixed", 3, 0, 4, False), "c": ("void", 1, 1, 4, False),
                   "d": ("object", 1, 0, 4, False), "odd name.x`": ("array", 1, 0, 4, False)}


def test_signature_of_no_records(spark):
    assert signature.learn_signature(spark.createDataFrame([("[]",), (None,)], "j string"), "j").count() == 0


def test_signatures_compared(spark):
    learn = lambda rows: signature.learn_signature(spark.createDataFrame([(json.dumps(r),) for r in rows], "j string"), "j")
    old = learn([{"same": 1, "gone": 1, "wide": 1, "narrow": 1.5, "turned": 1, "loose": "x", "was_null": None}])
    new = learn([{"same": 2, "wide": 1.5, "narrow": 1, "turned": "s", "loose": "x", "was_null": 1, "extra": 1},
                 {"same": 2, "wide": 1, "narrow": 1, "turned": "s", "was_null": 1, "extra": 1}])
    got = {r["field"]: r["change"] for r in signature.compare_signatures(old, new).collect()}
    assert got == {"same": "same", "gone": "missing", "wide": "widened", "narrow": "narrowed", "turned": "changed", "loose": "widened",
                   "was_null": "widened", "extra": "unknown"}


def test_quarantine_by_a_learned_signature(spark):
    learned = spark.createDataFrame([('{"x": 1.5, "n": 3, "t": "s"}',), ('{"x": 2, "n": 4}',)], "j string")
    fields = signature.signature_fields(signature.learn_signature(learned, "j"))
    assert fields == [("n", "bigint", True), ("t", "string", False), ("x", "double", True)]
    records = [{"x": 1, "n": 1}, {"x": 1.5, "n": 1, "t": "s"}, {"x": "s", "n": 1}, {"n": 1}, {"x": 1, "n": 1, "z": 1}, {"x": None, "n": 1}]
    payload = spark.createDataFrame([("q", json.dumps({S.RECORDS_FIELD: records})), ("bad", "oops")], f"{S.REQUEST_ID_FIELD} string, request string")
    got = {(r[0], r["record_pos"]): r["reason"] for r in P.quarantine(payload, fields=fields).collect()}
    assert got == {("q", 0): None, ("q", 1): None, ("q", 2): "bad_type:x", ("q", 3): "missing:x", ("q", 4): "unknown:z", ("q", 5): None,
                   ("bad", None): "unparsable_request"}
