"""Cleaning chain against the hand-derived golden table and extra edge rows."""

from __future__ import annotations

from tidemark.operators import clean
from tidemark.session import scratch_path

RAW_SCHEMA = ("PageID long, `Height (m)` double, `Weight (kg)` double, Universe string, Teams string, Origin string, "
              "Identity string, Gender string, `Marital Status` string, Alive string")
COLS = ["Id", "Height", "Weight", "Universe", "Teams", "Origin", "Magic", "Mutant", "Identity", "Gender",
        "Marital_Status", "Alive"]
PLAIN = {"Height (m)": 2.25, "Weight (kg)": 41.5, "Universe": "North", "Teams": None, "Origin": "Robot", "Identity": "Public",
         "Gender": "Female", "Marital Status": "Single", "Alive": "Alive"}
#: One rule per row: what differs from PLAIN, and what the rule makes of it (None: the row goes).
RULES = [
    ({}, {"Origin": "Robot", "Teams": 0, "Alive": 1}),
    ({"Universe": None}, {"Universe": "Other"}),
    ({"Universe": "Lonely"}, {"Universe": "Other"}),
    ({"Teams": "Crew"}, {"Teams": 1}),
    ({"Origin": None}, {"Origin": "Other"}),
    ({"Origin": "Subhuman being"}, {"Origin": "Human", "Magic": 0, "Mutant": 0}),
    ({"Origin": "a mutant fish"}, {"Mutant": 1}),
    ({"Origin": "old magic"}, {"Origin": "Other", "Magic": 1, "Mutant": 0}),
    ({"Identity": None}, {"Identity": "Unknown"}),
    ({"Identity": "Known Twice"}, None),
    ({"Gender": None}, {"Gender": "Other"}),
    ({"Marital Status": "Widow"}, {"Marital_Status": "Widowed"}),
    ({"Marital Status": None}, {"Marital_Status": "Unknown"}),
    ({"Marital Status": "Promised"}, None),
    ({"Alive": "Dead"}, {"Alive": 0}),
    ({"Alive": None}, None),
    ({"Height (m)": None, "Weight (kg)": None}, {"Height": None, "Weight": None}),
]


def _table(spark, rules):
    rows = [(100 + k, *(PLAIN | change).values()) for k, (change, _) in enumerate(rules)]
    return spark.createDataFrame(rows, RAW_SCHEMA)


def test_each_rule_on_its_row(spark):
    out = clean.clean_table(_table(spark, RULES), rare_threshold=5)
    assert set(out.columns) == set(COLS)
    got = {r["Id"]: r.asDict() for r in out.collect()}
    for k, (_, made) in enumerate(RULES):
        row = got.pop(str(100 + k), None)
        assert (row is None) == (made is None)
        assert all(row[name] == value for name, value in (made or {}).items()), RULES[k]
    assert not got


def test_rare_values_are_counted_before_rows_are_dropped(spark):
    # 15 rows of North, three of which other rules drop: at a threshold of 15 it is still frequent
    universes = {r["Universe"] for r in clean.clean_table(_table(spark, RULES), rare_threshold=15).collect()}
    assert universes == {"North", "Other"}
    assert {r["Universe"] for r in clean.clean_table(_table(spark, RULES), rare_threshold=16).collect()} == {"Other"}


def test_value_counts_and_rare(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "u string")
    assert [tuple(r) for r in clean.value_counts(df, "u").collect()] == [("a", 2), ("b", 1)]
    lumped = sorted(r["u"] for r in clean.rare_to_other(df.fillna("Unknown"), "u", 2).collect())
    assert lumped == ["Other", "Other", "a", "a"]


def test_csv_scan_missing_tokens_and_quotes(spark):
    from tidemark.sources import csv

    path = scratch_path(spark, "csv_test")
    tokens = ["NA", "null", "None", "n/a", "nan", "NULL", ""]
    lines = ["k,t,v", *[f"{i},{t},{t}" for i, t in enumerate(tokens)], '50,"two ""words"", one comma",1.5', '51,"first\nsecond",x', "52,plain,NaN"]
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(path)
    rows = {r["k"]: (r["t"], r["v"]) for r in csv.csv_scan(spark, path, "k int, t string, v double").collect()}
    assert all(rows[i] == (None, None) for i in range(len(tokens)))
    assert rows[50] == ('two "words", one comma', 1.5) and rows[51] == ("first\nsecond", None) and rows[52] == ("plain", None)


def test_cleaning_accounts_for_every_row(spark, sf_small):
    from tidemark.plans import standins as D

    raw = D.raw_characters(spark, sf_small)
    once = clean.clean_table(raw).cache()
    ids = {r["PageID"] for r in raw.select("PageID").collect()}
    kept = [int(r["Id"]) for r in once.select("Id").collect()]
    assert len(kept) == len(set(kept)) and set(kept) < ids  # no row twice, none made up, some dropped by the lists
    again = {r["Id"]: tuple(r[c] for c in COLS) for r in clean.clean_table(raw.repartition(3)).collect()}
    assert {r["Id"]: tuple(r[c] for c in COLS) for r in once.collect()} == again
