"""Joins, searches, sharding and mixing against brute force, and their edge cases."""

from __future__ import annotations

import random
import re

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import components, embedding_dedup, hilbert, mixing, ngram_join, sharding

SCHEMA = "doc_id bigint, text string, source string, shard string, mix string"
VECTORS = "vec_id bigint, embedding array<float>, label int"


def groups(items, linked):
    """Smallest member of each item's component."""
    root = {i: i for i in items}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in items}


def test_components(spark):
    rnd = random.Random(5)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(400, 470)] + [(500, k) for k in range(501, 560)]
    expected = {k: r for k, r in groups({x for e in edges for x in e}, edges).items() if k != r}
    got = components.connected_components(spark.createDataFrame(edges, "a bigint, b bigint"))
    assert {r.node: r.root for r in got.collect()} == expected
    assert components.connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def similar_brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    ids = sorted(sets)
    linked = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    n = {i: sum(i in pair for pair in linked) for i in ids}
    return {i: (len(sets[i]), c, n[i]) for i, c in groups(ids, linked).items()}


def test_ngram_join(spark):
    rnd = random.Random(8)
    words = [f"w{k}" for k in range(60)] + ["É", "ß", "it's", "A"]
    base = [[rnd.choice(words) for _ in range(rnd.randint(1, 120))] for _ in range(60)]
    rows = []
    for b in base:
        for _ in range(rnd.randint(1, 5)):
            c = list(b)
            for _ in range(rnd.randint(0, 3)):
                c[rnd.randrange(len(c))] = rnd.choice(words)
            rows.append(rnd.choice([" ", "\n", " \t "]).join(c))
    passage = " ".join(words[:30])
    rows += [passage + " " + " ".join(rnd.choice(words) for _ in range(9)) for _ in range(40)]
    rows += [None, "", "  ", "one", "ONE", "one two", "a b c d e", "a b c d e f", "x " * 30_000, "x " * 30_001, "x " * 30_000 + "y"]
    rows = list(enumerate(rows))
    got = ngram_join.similar(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in got.collect()} == similar_brute(rows)


def test_ngram_join_small_blocks(spark, monkeypatch):
    """Blocks of a group are split and still meet; overlaps are summed over several fragments."""
    rnd = random.Random(9)
    text = [f"t{k}" for k in range(150)]
    rows = []
    for i in range(70):
        c = list(text)
        for _ in range(i % 5):
            c[rnd.randrange(150)] = f"n{rnd.randrange(9)}"
        rows.append((i, " ".join(c)))
    for name, value in (("BLOCK_ROWS", 8), ("COLUMNS", 16), ("CHUNK", 500)):
        monkeypatch.setattr(ngram_join, name, value)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in ngram_join.similar(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == similar_brute(rows)
    sets = [np.sort(np.array(list({hash(x) for x in shingles(t)}), np.int64)) for _, t in rows]
    n = np.array([len(s) for s in sets])
    i, j = ngram_join.overlapping(n, sets, n, sets, 80)
    plain = {(a, b) for a in range(70) for b in range(70) if 100 * len(np.intersect1d(sets[a], sets[b])) >= 80 * len(np.union1d(sets[a], sets[b]))}
    assert set(zip(i.tolist(), j.tolist())) == plain


def test_ngram_join_edge_cases(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert ngram_join.similar(empty).count() == 0
    rows = spark.createDataFrame([(5, "a b c"), (None, "A B c"), (5, "a b c"), (7, "a  b c"), (None, None)], "doc_id bigint, text string")
    got = [tuple(r) for r in ngram_join.similar(rows).collect()]
    assert sorted(got, key=str) == sorted([(5, 1, 5, 3), (None, 1, 5, 3), (5, 1, 5, 3), (7, 1, 5, 3), (None, 0, None, 0)], key=str)


def vectors(spark, seed, extra=True):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(260, 16))
    for k in range(0, 120, 3):
        x[k + 1] = x[k] + rng.normal(size=16) * 0.05
        x[k + 2] = x[k] * 3
    x[200:240] = x[199] + rng.normal(size=(40, 16)) * 0.05
    x[240:250] = x[199]
    rows = [(i, [float(np.float32(v)) for v in r], 0) for i, r in enumerate(x)]
    if extra:
        nan, inf = float("nan"), float("inf")
        rows += [(300, None, 0), (301, [0.0] * 16, 0), (302, [nan] + [1.0] * 15, 0), (303, [inf] + [1.0] * 15, 0), (304, [None] + [1.0] * 15, 0), (305, [], 0), (306, [1.0, 2.0], 0)]
    return rows, spark.createDataFrame(rows, VECTORS)


def test_embedding_dedup(spark, monkeypatch):
    rows, df = vectors(spark, 1)
    fine = {i: np.array(v, np.float32).astype(float) for i, v, _ in rows[:260]}
    unit = {i: v / np.linalg.norm(v) for i, v in fine.items()}
    pairs = [(a, b) for a in unit for b in unit if a < b and unit[a] @ unit[b] >= 0.9]
    links = {i: 0 for i, _, _ in rows}
    for a, b in pairs:
        links[a] += 1
        links[b] += 1
    component = groups(links, pairs)
    for block in (2048, 7):
        monkeypatch.setattr(embedding_dedup, "BLOCK", block)
        got = {r.vec_id: r for r in embedding_dedup.link(df).collect()}
        assert len(got) == len(rows)
        assert sum(got[i].n_links for i in links) >= 0.97 * sum(links.values()) and all(got[i].n_links <= n for i, n in links.items())
        assert all(got[i].component_id == c and got[i].kept == (i == c) for i, c in component.items())
    assert embedding_dedup.link(df.limit(0)).count() == 0


def test_e8_decodes_to_the_nearest_point():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 8)) * 2
    got = embedding_dedup.decode(x)
    assert (np.isclose(got, np.rint(got)).all(axis=1) | np.isclose(got - 0.5, np.rint(got - 0.5)).all(axis=1)).all() and (got.sum(axis=1) % 2 == 0).all()
    d = ((x - got) ** 2).sum(axis=1)
    assert len(embedding_dedup.shortest()) == 240 and np.allclose((embedding_dedup.shortest() ** 2).sum(axis=1), 2)
    assert (d[:, None] <= ((x[:, None] - got[:, None] - embedding_dedup.shortest()) ** 2).sum(axis=2) + 1e-9).all()


def test_hilbert_curve_visits_every_cell_by_single_steps():
    for d, bits in ((2, 4), (3, 3)):
        side = np.arange(1 << bits)
        cells = np.stack(np.meshgrid(*[side] * d, indexing="ij"), -1).reshape(-1, d)
        keys = hilbert.hilbert_keys(cells, bits)
        assert sorted(keys) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_hilbert_search_equals_brute_force(spark, monkeypatch):
    rows, df = vectors(spark, 3)
    x = {i: np.array(v, np.float32).astype(float) for i, v, _ in rows[:260]}
    expected = {}
    for q in range(0, 260, 20):
        score = {i: float(hilbert.products(x[q][None], v[None])[0]) for i, v in x.items() if i != q}
        expected[q] = sorted(score.items(), key=lambda e: (-e[1], e[0]))[:20]
    for part in (4096, 16):
        monkeypatch.setattr(hilbert, "PART", part)
        got: dict[int, list] = {}
        for r in sorted(hilbert.search(df, F.col("vec_id") % 20 == 0).collect(), key=lambda r: (r.query_id, r.rank)):
            got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert got == expected
    few = hilbert.search(df.where("vec_id < 3"), F.col("vec_id") % 20 == 0).collect()
    assert [r.rank for r in sorted(few)] == [1, 2]
    assert hilbert.search(df.limit(0), F.lit(True)).count() == 0


def test_hilbert_search_with_repeated_rows(spark, monkeypatch):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 8)).astype(np.float32)
    rows = [(i, [float(c) for c in v], 0) for i, v in enumerate(x)]
    rows += [(7, rows[7][1], 0)] * 30 + [(9, rows[9][1], 0)] + [(9, rows[10][1], 0)]  # over k times; twice, and another vector
    rows += [(20, rows[20][1], 0)] * 2 + [(40, rows[41][1], 0)]  # a query three times; one with two vectors
    rows += [(301, [c * 9 for c in rows[k][1]], 0) for k in (0, 60, 80) for _ in range(6)]  # nearest to some queries, fewer than k
    vec = {id(r): np.array(r[1], np.float32).astype(float) for r in rows}
    expected = {}
    for q in range(0, 300, 20):
        pairs = [(c[0], float(hilbert.products(vec[id(r)][None], vec[id(c)][None])[0])) for r in rows if r[0] == q for c in rows if c[0] != q]
        expected[q] = sorted(pairs, key=lambda e: (-e[1], e[0]))[:20]
    for part in (4096, 16):
        monkeypatch.setattr(hilbert, "PART", part)
        got: dict[int, list] = {}
        for r in sorted(hilbert.search(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 20 == 0).collect(), key=lambda r: (r.query_id, r.rank)):
            got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert got == expected


def test_sharding_is_exact_and_uniform(spark):
    df = spark.createDataFrame([(i if i % 7 else None, "same" if i % 3 else None, None, "old", None) for i in range(1003)], SCHEMA).repartition(5)
    out = sharding.shard(df.withColumn("row", F.col("doc_id")), 16).collect()
    assert len(out) == 1003 and {len([r for r in out if r.shard == s]) for s in range(16)} == {62, 63}
    assert all(sorted(r.slot for r in out if r.shard == s) == list(range(len([r for r in out if r.shard == s]))) for s in range(16))
    assert sorted(r.doc_id or -1 for r in out) == sorted(i if i % 7 else -1 for i in range(1003))
    m = sharding.communication_matrix([10, 0, 500, 37], 16, 1)
    assert m.sum(axis=1).tolist() == [10, 0, 500, 37] and set(m.sum(axis=0)) == {34, 35}
    for size in (1, 2, 3, 100, 1025):
        assert sorted(sharding.permuted(np.arange(size), size, 5)) == list(range(size))
    mean = np.mean([sharding.communication_matrix([20, 60], 4, s)[0] for s in range(400)], axis=0)
    assert np.abs(mean - 5).max() < 0.4
    big = sharding.draw_row(np.random.default_rng(1), np.full(4, 10**9), 4000)  # beyond the library's bound
    assert big.sum() == 4000 and np.abs(big - 1000).max() < 150
    assert sharding.shard(df.limit(0), 4).count() == 0


def water_fill_brute(sizes, weights, cap):
    target, open_ = {}, dict(sizes)
    total = sum(sizes.values())
    while open_:
        left = total - sum(target.values())
        level = left / sum(weights[s] for s in open_)
        over = [s for s in open_ if level * weights[s] >= cap * sizes[s]]
        if not over:
            return target | {s: level * weights[s] for s in open_}
        for s in over:
            target[s] = float(cap * sizes[s])
            del open_[s]
    return target


def test_mixing(spark):
    rnd = random.Random(4)
    rows = [(i, "w " * rnd.randint(0, 60) or None, rnd.choice([None, "a", "a", "a", "b", "c", "d", "é"]), "x", "y") for i in range(800)] + [(900, "big " * 5000, "é", None, None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = mixing.mix(df)
    got = out.collect()
    assert out.columns == df.columns and len(got) == 801  # the input's column mix gives way
    sizes: dict = {}
    for _, t, s, _, _ in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    expected = water_fill_brute(sizes, {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}, 3)
    for s, want in expected.items():
        mine = [r.mix for r in got if r.source == s]
        assert all(abs(m.target - want) < 1e-6 and m.source_size == sizes[s] for m in mine)
        assert abs(sum(m.taken for m in mine) - want) <= max(m.size for m in mine) / 2 + 1e-6
        assert all(0 <= m.taken <= 3 * m.size and m.taken == m.size * m.repeats for m in mine)
    assert sorted(out.collect()) == sorted(mixing.mix(df.repartition(7)).select(*out.columns).collect()) if None not in sizes else True
    assert mixing.repeated(out).count() == sum(r.mix.repeats for r in got)
    assert mixing.mix(df.limit(0)).count() == 0
    alone = mixing.mix(spark.createDataFrame([(1, "a b", None, None, None), (1, "a b", None, None, None), (2, "", None, None, None)], SCHEMA)).collect()
    assert sorted(r.mix.taken for r in alone) == [0, 2, 2]
