"""Whitening of vectors by their leading principal components.

1. Rows become whole numbers, floor(``scale`` * x); each distinct vector stands once in the fit list.  Copies are folded before
   they are shuffled.
2. Tasks sum the fit list per dimension (exactly, in two halves of each number), then a second pass sums the products of the
   centred components in blocks; Spark adds the tasks' partial sums entry by entry.  The driver gets one number per pair of dimensions.
3. The covariance is brought to tridiagonal form by Householder reflections.  The leading eigenvalues come from
   bisection on Sturm counts.  Each one's vector comes from inverse iteration on the tridiagonal matrix; vectors whose
   eigenvalues lie close together are made orthogonal to each other in every round.  The reflections lead back.
4. The components are broadcast and every row is projected in one narrow stage.  ``identity_error`` is measured by one more pass
   over the fit list: the largest entry of (covariance of the whitened vectors - identity).

Rows whose vector is null, empty or holds null or non-finite components are left out.  Vectors of different length are whitened
each among their own.  Rows with a null id take part and stay.  Repeated rows have a result each.  Components without variance
(eigenvalues of less than 10^-12 of the trace) are left out, so fewer than ``components`` can come out, and none of a single
distinct vector or an empty table.  Whole numbers beyond +-2^53 are held there; a ``deviation`` beyond 64 bits is null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import small_batches
from tidemark.session import materialize

ROWS = 4096
HALF = 1 << 26
NO_VARIANCE = 1e-12


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal and off-diagonal of a symmetric matrix after Householder reflections, and the reflections' unit vectors."""
    a, n, mirrors = a.copy(), len(a), []
    for k in range(n - 2):
        x = a[k + 1 :, k]
        v = x.copy()
        v[0] += np.copysign(np.sqrt(x @ x), x[0])
        size = np.sqrt(v @ v)
        if size == 0:
            mirrors.append(v)
            continue
        v /= size
        mirrors.append(v)
        rest = a[k + 1 :, k + 1 :]
        w = rest @ v
        w -= (v @ w) * v
        rest -= 2 * (np.outer(v, w) + np.outer(w, v))
        x -= 2 * (v @ x) * v
    return np.diag(a).copy(), np.diag(a, -1).copy(), mirrors


def count_below(diagonal: np.ndarray, off: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Sturm counts: how many eigenvalues lie below each x."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    floor = max(tiny, np.finfo(float).eps ** 2 * float(np.max(np.abs(off), initial=0.0)))
    below, q = np.zeros(len(x), int), np.ones(len(x))
    for k, d in enumerate(diagonal):
        q = d - x - (off[k - 1] ** 2 / q if k else 0.0)
        q = np.where(np.abs(q) < floor, -floor, q)
        below += q < 0
    return below


def leading(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, largest first, by bisection until the ends of each interval are neighbours."""
    n = len(diagonal)
    around = np.concatenate([[0.0], np.abs(off), [0.0]])
    around = around[:-1] + around[1:]
    lo = np.full(k, (diagonal - around).min())
    hi = np.full(k, (diagonal + around).max())
    hi += np.maximum(np.abs(hi), np.abs(lo)) * 1e-15
    wanted = n - 1 - np.arange(k)  # eigenvalue number j (from 0, rising) is at least x if at most j lie below x
    for _ in range(2100):
        middle = lo + (hi - lo) / 2
        if ((middle <= lo) | (middle >= hi)).all():
            break
        up = count_below(diagonal, off, middle) <= wanted
        lo, hi = np.where(up, middle, lo), np.where(up, hi, middle)
    return lo


def solve(diagonal: np.ndarray, off: np.ndarray, shift: float, right: np.ndarray) -> np.ndarray:
    """(T - shift) y = right, by elimination with row exchanges; a vanishing pivot is replaced by a tiny one."""
    n = len(diagonal)
    eps = np.finfo(float).eps * max(float(np.abs(diagonal).max()), float(np.max(np.abs(off), initial=0.0)), np.finfo(float).tiny)
    y = right.copy()
    main, above, second = diagonal - shift, np.append(off, 0.0), np.zeros(n)
    for k in range(n - 1):
        below = off[k]
        if abs(main[k]) < abs(below):  # row k + 1 goes first
            m = main[k] / below
            main[k], next_main = below, above[k] - m * main[k + 1]
            above[k], second[k], next_above = main[k + 1], above[k + 1], -m * above[k + 1]
            main[k + 1], above[k + 1] = next_main, next_above
            y[k], y[k + 1] = y[k + 1], y[k] - m * y[k + 1]
        else:
            if main[k] == 0:
                main[k] = eps
            m = below / main[k]
            main[k + 1] -= m * above[k]
            y[k + 1] -= m * y[k]
    for k in reversed(range(n)):
        total = y[k] - (above[k] * y[k + 1] if k + 1 < n else 0.0) - (second[k] * y[k + 2] if k + 2 < n else 0.0)
        y[k] = total / (main[k] if abs(main[k]) > eps else np.copysign(eps, main[k]))
    return y


def vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit vectors of the eigenvalues, one per line."""
    near = 1e-3 * max(float(np.abs(diagonal).max()), float(np.max(np.abs(off), initial=0.0)))
    out: list[np.ndarray] = []
    start = np.random.default_rng(5)
    cluster = 0
    for k, value in enumerate(values):
        if k and values[k - 1] - value > near:
            cluster = k
        v = start.normal(size=len(diagonal))
        for _ in range(6):
            for u in out[cluster:]:
                v -= (u @ v) * u
            v /= np.sqrt(v @ v)
            v = solve(diagonal, off, value, v)
            v /= np.abs(v).max()
        for _ in range(2):
            for u in out[cluster:]:
                v -= (u @ v) * u
            v /= np.sqrt(v @ v)
        out.append(v)
    return np.array(out)


def principal(covariance: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of a symmetric matrix and their unit vectors, one per line."""
    size = float(np.abs(covariance).max()) or 1.0
    diagonal, off, mirrors = tridiagonal(covariance / size)
    values = leading(diagonal, off, min(k, len(diagonal)))
    lines = vectors(diagonal, off, values)
    for at in reversed(range(len(mirrors))):
        v = mirrors[at]
        lines[:, at + 1 :] -= 2 * np.outer(lines[:, at + 1 :] @ v, v)
    return values * size, lines


def matrices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[np.ndarray]:
    """The vectors of each batch as matrices, one per length and ``ROWS`` rows."""
    for b in batches:
        v = b.column(b.schema.get_field_index(column))
        sizes = pc.list_value_length(v).to_numpy()
        for d in np.unique(sizes).tolist():
            x = v.filter(pa.array(sizes == d)).flatten().to_numpy().reshape(-1, d)
            for at in range(0, len(x), ROWS):
                yield x[at : at + ROWS]


def usable(vector_col: str) -> F.Column:
    v = F.col(vector_col)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(fine, F.lit(False)) & (F.size(v) > 0)


def totals(listed: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """By length: the number of vectors and the exact sum of each dimension."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for x in matrices(batches, "x"):
            high, low = np.divmod(x, HALF)
            s = held.setdefault(x.shape[1], [0, 0, 0])
            s[0], s[1], s[2] = s[0] + len(x), s[1] + high.sum(axis=0), s[2] + low.sum(axis=0)
        for d, (n, high, low) in held.items():
            yield pa.RecordBatch.from_pydict({"d": pa.array([d] * d, pa.int32()), "place": pa.array(range(d), pa.int32()), "n": pa.array([n] * d, pa.int64()), "high": pa.array(high), "low": pa.array(low)})

    rows = listed.mapInArrow(sums, "d int, place int, n bigint, high bigint, low bigint").groupBy("d", "place")
    out: dict[int, tuple[int, list[int]]] = {}
    for r in rows.agg(F.sum("n").alias("n"), F.sum(F.col("high").cast("decimal(38,0)")).alias("high"), F.sum(F.col("low").cast("decimal(38,0)")).alias("low")).collect():
        out.setdefault(r.d, (r.n, [0] * r.d))[1][r.place] = int(r.high) * HALF + int(r.low)
    return out


def products(listed: DataFrame, shift: dict[int, np.ndarray], turn: dict[int, np.ndarray] | None = None) -> dict[int, np.ndarray]:
    """By length: the sums of products of (x - shift), turned by a matrix if one is given; the last line and column hold plain sums."""
    shared = listed.sparkSession.sparkContext.broadcast((shift, turn))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift, turn = shared.value
        held: dict[int, np.ndarray] = {}
        for x in matrices(batches, "x"):
            d = x.shape[1]
            c = x - shift[d]
            c = c @ turn[d].T if turn else c
            c = np.column_stack([c, np.ones(len(c))])
            held[d] = held.get(d, 0.0) + c.T @ c
        for d, s in held.items():
            a, b = np.triu_indices(len(s))
            yield pa.RecordBatch.from_pydict({"d": pa.array(np.full(len(a), d, np.int32)), "a": pa.array(a.astype(np.int32)), "b": pa.array(b.astype(np.int32)), "total": pa.array(s[a, b])})

    rows = listed.mapInArrow(sums, "d int, a int, b int, total double").groupBy("d", "a", "b").agg(F.sum("total").alias("total")).collect()
    out: dict[int, np.ndarray] = {}
    for d in {r.d for r in rows}:
        size = (len(turn[d]) if turn else d) + 1
        out[d] = np.zeros((size, size))
    for r in rows:
        out[r.d][r.a, r.b] = out[r.d][r.b, r.a] = r.total
    return out


def covariance(products: np.ndarray, n: int) -> np.ndarray:
    """From sums of centred products; what the shift's rounding left is taken out."""
    left = products[-1, :-1] / n
    return products[:-1, :-1] / n - np.outer(left, left)


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 4, scale: int = 256) -> DataFrame:
    """Per usable row and component: id, ``component`` (from 1), ``n``, ``deviation``, ``whitened``, ``explained`` and ``identity_error``."""
    spark = df.sparkSession
    small_batches(spark, ROWS)
    vector = F.col(vector_col).cast("array<double>")
    most = 1 << 53
    whole = F.transform(vector, lambda x: F.greatest(F.least(F.floor(x * scale), F.lit(most)), F.lit(-most)))
    rows = df.where(usable(vector_col)).select(F.col(id_col).alias("id"), whole.alias("x"))
    listed = materialize(rows.select("x").distinct())
    sums = totals(listed)
    mean = {d: np.array([s / n for s in total]) for d, (n, total) in sums.items()}
    found: dict[int, tuple[np.ndarray, np.ndarray, float]] = {}
    for d, p in products(listed, mean).items():
        v = covariance(p, sums[d][0])
        values, lines = principal(v, components)
        good = values > NO_VARIANCE * np.trace(v)
        found[d] = values[good], lines[good] / np.sqrt(values[good])[:, None], float(np.trace(v))
    error = {d: 0.0 for d in found}
    if any(len(values) for values, _, _ in found.values()):
        for d, p in products(listed, mean, {d: turn for d, (_, turn, _) in found.items()}).items():
            if len(found[d][0]):
                error[d] = float(np.abs(covariance(p, sums[d][0]) - np.eye(len(found[d][0]))).max())
    shared = spark.sparkContext.broadcast((sums, mean, found, error))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, mean, found, error = shared.value
        for b in batches:
            sizes = pc.list_value_length(b.column(1)).to_numpy()
            for d in np.unique(sizes).tolist():
                values, turn, trace = found[d]
                k, here = len(values), pa.array(sizes == d)
                if not k:
                    continue
                n, total = sums[d]
                x = b.column(1).filter(here).flatten().to_numpy().reshape(-1, d)
                ids = b.column(0).filter(here)
                for at in range(0, len(x), ROWS):
                    part = x[at : at + ROWS]
                    white = (part - mean[d]) @ turn.T
                    m = len(part)
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.slice(at, m).take(pa.array(np.repeat(np.arange(m), k))),
                            pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                            pa.array(np.full(m * k, n, np.int64)),
                            deviations(part, n, total).take(pa.array(np.repeat(np.arange(m), k))),
                            pa.array(white.ravel()),
                            pa.array(np.tile(values / trace, m)),
                            pa.array(np.full(m * k, error[d])),
                        ],
                        names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"],
                    )

    kind = df.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(project, f"`{id_col}` {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")


def deviations(x: np.ndarray, n: int, total: list[int]) -> pa.Array:
    """Exact sums of (n x - total)^2; in whole numbers of any size where 64 bits might not hold them."""
    most = n * int(np.abs(x).max(initial=0)) + max(map(abs, total))
    if most * most * len(total) < 1 << 62:
        return pa.array(((n * x - np.array(total, np.int64)) ** 2).sum(axis=1))
    exact = [sum((n * c - s) ** 2 for c, s in zip(line, total)) for line in x.tolist()]
    return pa.array([e if e < 1 << 63 else None for e in exact], pa.int64())
