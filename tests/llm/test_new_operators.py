"""Whitening, hard negatives and decontamination against brute force, and their edge cases."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import decontamination, hard_negatives, whitening
from tidemark.llm.queries import QUERIES

VECTORS = "vec_id bigint, embedding array<float>, label int, score string, n int"
NAN, INF = float("nan"), float("inf")
ODD = [(900, None, 1, "s", 1), (901, [], 1, "s", 1), (902, [NAN] + [0.0] * 7, 1, "s", 1), (903, [INF] + [0.0] * 7, 1, "s", 1), (904, [None] + [0.0] * 7, 1, "s", 1)]


def whole(v, scale=256):
    return np.floor(np.asarray(v, np.float32).astype(float) * scale).astype(np.int64)


# whitening


def check_whitening(rows, got, components):
    fit = [(i, whole(v)) for i, v, *_ in rows if v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v)]
    for d in {len(x) for _, x in fit}:
        mine = [(i, x) for i, x in fit if len(x) == d]
        listed = np.unique(np.stack([x for _, x in mine]), axis=0)
        n, total = len(listed), listed.sum(axis=0)
        c = listed - total / n
        values, vectors = np.linalg.eigh(c.T @ c / n)
        values, vectors = values[::-1], vectors.T[::-1]
        k = int((values[:components] > 1e-12 * values.sum()).sum())
        out = sorted([r for r in got if r.size == d], key=lambda r: (r.component, r.vec_id is None, r.vec_id or 0, r.deviation))
        assert len(out) == k * len(mine)
        order = sorted(mine, key=lambda m: (m[0] is None, m[0] or 0, int(((n * m[1] - total) ** 2).sum())))
        for j in range(k):
            part = out[j * len(mine) : (j + 1) * len(mine)]
            assert [r.vec_id for r in part] == [i for i, _ in order]
            assert [r.deviation for r in part] == [int(((n * x - total) ** 2).sum()) for _, x in order]
            assert all(r.n == n and abs(r.explained - values[j] / values.sum()) < 1e-9 and r.identity_error < 1e-9 for r in part)
            want = np.array([(x - total / n) @ vectors[j] for _, x in order]) / np.sqrt(values[j])
            white = np.array([r.whitened for r in part])
            assert min(np.abs(white - want).max(), np.abs(white + want).max()) < 1e-8


def whitened(spark, rows, components=4):
    df = spark.createDataFrame(rows, VECTORS)
    out = whitening.whiten(df, components=components)
    sizes = df.where("embedding IS NOT NULL").select("vec_id", F.size("embedding").alias("size")).distinct()
    return [r for r in out.join(sizes, out.vec_id.eqNullSafe(sizes.vec_id)).drop(sizes.vec_id).collect()]


def test_whitening(spark):
    rng = np.random.default_rng(2)
    spread = rng.normal(size=(8, 8))
    rows = [(i, [float(c) for c in rng.normal(size=8) @ spread], 1, "s", 1) for i in range(150)]
    rows += [rows[3], rows[3], (500, rows[4][1], 2, "t", 2)] + ODD
    rows += [(600 + i, [float(c) for c in rng.normal(size=3)], 1, "s", 1) for i in range(20)]  # another length
    check_whitening(rows, whitened(spark, rows), 4)
    check_whitening(rows, whitened(spark, rows, 2), 2)


def test_whitening_without_variance(spark):
    assert whitening.whiten(spark.createDataFrame([], VECTORS)).count() == 0
    assert whitened(spark, ODD) == []
    assert whitened(spark, [(1, [1.0, 2.0], 1, "s", 1)] * 3) == []
    line = [(i, [float(i), float(2 * i), 0.0], 1, "s", 1) for i in range(9)]
    assert {r.component for r in whitened(spark, line)} == {1}
    far = [(1, [3e38, 0.0], 1, "s", 1), (2, [-3e38, 1.0], 1, "s", 1), (3, [0.0, 5.0], 1, "s", 1)]
    assert {r.deviation for r in whitened(spark, far)} == {None, (3 * 1280 - 1536) ** 2}
    null_id = whitening.whiten(spark.createDataFrame([(None, [1.0, 0.0], 1, "s", 1), (2, [0.0, 3.0], 1, "s", 1)], VECTORS)).collect()
    assert {(r.vec_id, r.component) for r in null_id} == {(None, 1), (2, 1)}


def test_equal_eigenvalues_give_orthogonal_vectors():
    values, lines = whitening.principal(np.eye(40) * 7.0, 4)
    assert np.abs(values - 7).max() < 1e-12 and np.abs(lines @ lines.T - np.eye(4)).max() < 1e-12


def test_whitening_query(spark, sf_small):
    rows = [tuple(r) + ("", 0) for r in spark.read.parquet(f"{sf_small}/embeddings.parquet").collect()]
    got = QUERIES["op11_whitening"](spark, sf_small).withColumn("size", F.lit(len(rows[0][1]))).collect()
    check_whitening(rows, got, 4)


# hard negatives


def mine_brute(rows, positives, negatives, low, high, every):
    fit = [(i, label, whole(v)) for i, v, label, *_ in rows if i is not None and label is not None and v and all(c is not None and np.isfinite(c) for c in v)]
    out = []
    for i, label, x in {(i, label, tuple(v)) for i, label, v in fit if i % every == 0}:
        scored = sorted((-int(np.dot(x, v)), j, other) for j, other, v in fit if j != i and len(v) == len(x))
        for s, p, _ in [t for t in scored if t[2] == label][:positives]:
            window = [(j, -t) for t, j, other in scored if other != label and low * -s <= 100 * -t <= high * -s][:negatives]
            out += [(i, p, k + 1, j, -s, t) for k, (j, t) in enumerate(window)]
    return sorted(out)


@pytest.mark.parametrize("block,group", [(2048, 256), (16, 3)])
def test_hard_negatives(spark, monkeypatch, block, group):
    monkeypatch.setattr(hard_negatives, "BLOCK", block)
    monkeypatch.setattr(hard_negatives, "GROUP", group)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(3, 20))
    rows = [(i, [float(c) for c in centres[i % 3] + rng.normal(size=20)], int(rng.integers(0, 3)), "s", 1) for i in range(160)]
    rows += [(200 + i, rows[5][1], i % 2, "s", 1) for i in range(30)]  # ties
    rows += [rows[10], rows[11], (None, rows[0][1], 1, "s", 1), (300, rows[0][1], None, "s", 1)] + ODD
    rows += [(400 + i, [1.0, float(i)], i % 2, "s", 1) for i in range(12)]  # another length
    df = spark.createDataFrame(rows, VECTORS)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    for positives, negatives, low, high in ((5, 10, 30, 90), (3, 2, 0, 100), (40, 25, 50, 99)):
        got = hard_negatives.mine(df, F.col("vec_id") % 5 == 0, positives=positives, negatives=negatives, low=low, high=high)
        assert sorted(map(tuple, got.collect())) == mine_brute(rows, positives, negatives, low, high, 5)
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_hard_negatives_without_rows(spark):
    assert hard_negatives.mine(spark.createDataFrame([], VECTORS), F.lit(True)).count() == 0
    one_label = spark.createDataFrame([(i, [1.0, 2.0], 1, "s", 1) for i in range(6)], VECTORS)
    assert hard_negatives.mine(one_label, F.lit(True)).count() == 0
    assert hard_negatives.mine(one_label, F.lit(False)).count() == 0


# decontamination

DOCS = "doc_id bigint, text string, item_id string, found string"


def search_brute(docs, items, window):
    cut = lambda t: [m.span() for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))]
    low = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    phrases = {}
    for i, t in items:
        w = [low(t)[a:b] for a, b in cut(t)]
        for k in range(max(1, len(w) - window + 1) if w else 0):
            phrases.setdefault(tuple(w[k : k + window]), set()).add(i)
    out = []
    for doc, text in docs:
        spans = cut(text)
        w = [low(text)[a:b] for a, b in spans]
        hit, met = [False] * len(w), set()
        for size in {len(p) for p in phrases}:
            for k in range(len(w) - size + 1):
                if (p := tuple(w[k : k + size])) in phrases:
                    hit[k : k + size] = [True] * size
                    met |= phrases[p]
        runs = []
        for k, h in enumerate(hit):
            if h and k and hit[k - 1]:
                runs[-1][1], runs[-1][3] = k + 1, spans[k][1]
            elif h:
                runs.append([k, k + 1, *spans[k]])
        out.append((doc, len(w), sum(hit), tuple(map(tuple, runs)), tuple(sorted(i for i in met if i is not None))))
    return sorted(out, key=str)


def found_rows(df):
    return sorted([(r.doc_id, r.f.n_words, r.f.n_hit, tuple(map(tuple, r.f.spans)), tuple(r.f["items"])) for r in df.collect()], key=str)


@pytest.mark.parametrize("phrase_bytes,shard_words", [(1 << 20, 500_000), (60, 40)])
def test_decontamination(spark, monkeypatch, phrase_bytes, shard_words):
    monkeypatch.setattr(decontamination, "SHARD_WORDS", shard_words)
    rnd = random.Random(4)
    words = ["a", "B", "cc", "été", "日本", "x1", "𝄞", "naïve", "zz9", "Q"]
    text = lambda n: "".join(rnd.choice(words) + rnd.choice([" ", ", ", "\n", "--", "_"]) for _ in range(n))
    items = [(str(i), text(rnd.choice([1, 2, 3, 4, 5, 9]))) for i in range(25)] + [("7", text(5)), (None, text(4)), ("50", None), ("51", ""), ("52", " .. "), ("3", text(6)), ("3", text(6))]
    items.append(items[0])
    docs = [(i, text(rnd.choice([0, 1, 3, 30, 200]))) for i in range(120)]
    docs += [(500 + i, "-- " + (items[i][1] or "") * 2 + " tail") for i in range(len(items))] + [(600, None), (601, ""), (602, "?!"), (None, text(20)), docs[5], docs[5]]
    docs += [(700, text(5000)), (701, "a " * 3000), (702, ("a B cc " * 400))]
    df = spark.createDataFrame([(*d, "x", "y") for d in docs], DOCS)
    bench = spark.createDataFrame([(*i, 1) for i in items], "item_id string, text string, doc_id int")
    got = decontamination.search(df, bench, window=4, out="f", phrase_bytes=phrase_bytes)
    assert got.columns == [*df.columns, "f"]
    assert found_rows(got) == search_brute(docs, items, 4)
    cut = {r.doc_id: r.text for r in decontamination.without_spans(got, found="f").where("doc_id >= 500").collect()}
    texts, spans = dict(docs), {d: s for d, _, _, s, _ in search_brute(docs, items, 4)}
    for d, t in cut.items():
        want, at = [], 0
        for _, _, a, b in spans[d]:
            want.append(texts[d][at:a])
            at = b
        assert t == (None if texts[d] is None else "".join([*want, texts[d][at:]]))


def test_decontamination_without_rows(spark):
    none = spark.createDataFrame([], DOCS)
    items = spark.createDataFrame([("1", "a b c")], "item_id string, text string")
    assert decontamination.search(none, items).count() == 0
    docs = spark.createDataFrame([(1, "a b c", "x", "y"), (2, None, "x", "y")], DOCS)
    assert found_rows(decontamination.search(docs, items.where("item_id = 'none'"), out="f")) == [(1, 3, 0, (), ()), (2, 0, 0, (), ())]
    assert found_rows(decontamination.search(docs, items, out="f")) == [(1, 3, 3, ((0, 3, 0, 5),), ("1",)), (2, 0, 0, (), ())]


def test_index_finds_every_place():
    rnd = random.Random(1)
    for _ in range(40):
        text = [0]
        for _ in range(rnd.randint(1, 8)):
            text += [rnd.randint(1, 3) for _ in range(rnd.randint(1, 20))] + [0]
        index = decontamination.Index(np.array(text), 3)
        for size in (1, 2, 4):
            phrases = sorted({tuple(rnd.randint(1, 3) for _ in range(size)) for _ in range(15)})
            got = {phrases[a]: sorted(index.places(np.arange(lo, hi)).tolist()) for a, lo, hi in zip(*index.rows(np.array(phrases)))}
            places = {p: [k for k in range(len(text)) if tuple(text[k : k + size]) == p] for p in phrases}
            assert got == {p: k for p, k in places.items() if k}


def test_sha_of_items_in_the_query(spark, sf_small):
    rows = QUERIES["op13_decontamination"](spark, sf_small).collect()
    assert {r.items_sha256 for r in rows if not r.contaminated} == {hashlib.sha256(b"").hexdigest()}
