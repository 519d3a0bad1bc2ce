"""Quality by nearest-neighbour voting over latent-semantic vectors.

The terms of a text are pairs of neighbouring character classes (capitals,
small letters, digits, separate punctuation marks and so on) and the shares of
repeated words and lines, weighted by inverse document frequency.  Labelled
texts span a latent space (truncated singular vectors of their term matrix);
their vectors and labels are broadcast, and every text's cosine with all of
them is computed exactly in blocks.  The nearest vote with their similarity.

Learning reads at most ``max_labelled`` labelled rows (the documented bound of
the broadcast: that many vectors of ``rank`` numbers); scoring reads every
whole text once and shuffles nothing.

Null and empty texts have no terms; they get the share of label 1 among the
learned rows without terms, or else score 0.  Repeated label rows of one id
vote by their mean.  Without any usable label every score is 0.5.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words as W
from tidemark.llm.frames import map_batches, slices, with_field

CHARS = 1 << 19
KINDS = 32
#: Separate classes of frequent marks; every other character has the class of its kind.
MARKS = "\n.,!?;:'\"()-_$&#%*|/<>@"
PAIRS = KINDS * KINDS
EXTRA = 20
BLOCK = 512


@lru_cache(1)
def kinds() -> np.ndarray:
    letters = W.classes()
    out = np.select([letters == W.LETTER, letters == W.NUMBER, letters == W.SPACE], [1, 3, 4], 5).astype(np.uint8)
    low = W.lowered()
    out[(letters == W.LETTER) & (low != np.arange(len(low)))] = 2
    for i, c in enumerate(MARKS):
        out[ord(c)] = 6 + i
    out[W.PIECE] = 0
    return out


def shares(owner: np.ndarray, part: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(owner[part], minlength=n) / np.maximum(np.bincount(owner, minlength=n), 1)


def terms(texts: list[str]) -> np.ndarray:
    """Square roots of term shares, text x term."""
    n = len(texts)
    cp = W.code_points(texts)
    marks = np.flatnonzero(cp == W.PIECE)
    owner = np.repeat(np.arange(n), np.diff(np.concatenate([[-1], marks])))
    kind = kinds()[cp].astype(np.int64)
    inside = np.flatnonzero((kind[1:] > 0) & (kind[:-1] > 0))
    pair = kind[inside] * KINDS + kind[inside + 1]
    out = np.zeros((n, PAIRS + EXTRA), np.float32)
    counts = np.bincount(owner[inside] * PAIRS + pair, minlength=n * PAIRS).reshape(n, PAIRS)
    out[:, :PAIRS] = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)

    def runs(breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hash and text of every run between breaks."""
        edge = np.diff(np.concatenate([[0], (~breaks).astype(np.int8), [0]]))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        return W.word_hashes(cp, starts, ends)[0], owner[starts]

    hashes, of = runs((W.classes()[cp] == W.SPACE) | (kind == 0))
    if len(hashes):
        words = np.bincount(of, minlength=n)
        again = np.flatnonzero((hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1])) + 1
        out[:, PAIRS] = 3 * shares(of, again, n)
        mixed = hashes ^ (of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        _, first = np.unique(mixed, return_index=True)
        out[:, PAIRS + 1] = np.where(words >= 20, 1 - shares(of, first, n), 0) ** 4  # few distinct words
        lines, lines_of = runs((cp == 10) | (kind == 0))
        _, first = np.unique(lines ^ (lines_of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)
        several = np.bincount(lines_of, minlength=n) >= 4
        out[:, PAIRS + 2] = np.where(several, 1 - shares(lines_of, first, n), 0)
        length = np.minimum(np.log2(np.maximum(words, 1)).astype(int), EXTRA - 5)
        out[np.arange(n), PAIRS + 4 + length] = np.where(words > 0, 0.01, 0)
    return np.sqrt(out)


def chunks(texts: list[str]):
    for lo, hi in slices([len(t) for t in texts], CHARS):
        for a in range(lo, hi, BLOCK):
            yield terms(texts[a : min(hi, a + BLOCK)])


@dataclass
class Voters:
    """Latent vectors of learned rows, their labels, and the map from terms to the latent space."""

    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    blank: float
    neighbours: int

    def latent(self, x: np.ndarray) -> np.ndarray:
        z = x @ self.basis
        return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = self.latent(x)
        cosine = z @ self.vectors.T
        k = min(self.neighbours, cosine.shape[1])
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        c = np.take_along_axis(cosine, near, axis=1).astype(np.float64)
        # similarity relative to the k-th: what is much nearer than the rest decides
        gap = 1 - c
        weight = 1 / (gap + 0.05 * gap.max(axis=1, keepdims=True) + 1e-4)
        weight *= np.maximum(c, 1e-6)
        out = (weight * self.labels[near]).sum(axis=1) / weight.sum(axis=1)
        return np.where(x.any(axis=1), out, self.blank)


def learn(x: np.ndarray, y: np.ndarray, rank: int, neighbours: int) -> Voters | None:
    has = x.any(axis=1)
    blank = float(y[~has].mean()) if (~has).any() else 0.0
    x, y = x[has], y[has]
    if not len(x):
        return None
    idf = np.log((1 + len(x)) / (1 + (x > 0).sum(axis=0))).astype(np.float32) + 1
    # right singular vectors from the term-by-term matrix: its size depends on the number of terms alone
    weighted = x.astype(np.float64) * idf
    _, vectors = np.linalg.eigh(weighted.T @ weighted)
    basis = (idf[:, None] * vectors[:, ::-1][:, :rank]).astype(np.float32)
    out = Voters(basis, np.zeros((0, rank), np.float32), y.astype(np.float64), blank, neighbours)
    out.vectors = out.latent(x)
    return out


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, max_labelled: int, rank: int, neighbours: int) -> Voters | None:
    """``labels``: the rows to learn from.  A sample of ids by hash, then one pass over the texts of those ids."""
    ids = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.avg(F.col(label_col)).alias("y"))
    ids = ids.orderBy(F.xxhash64(F.lit(5), "id"), "id").limit(max_labelled)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(ids), "id")  # max_labelled ids
    rows = rows.groupBy("id", "y").agg(F.min("text").alias("text"))

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        found = [row.tobytes() for x in chunks([t or "" for t in b.column(1).to_pylist()]) for row in x]
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.binary())], ["y", "x"])

    got = map_batches(rows.select("y", "text"), batch, "y double, x binary").toArrow()
    if not got.num_rows:
        return None
    x = np.frombuffer(b"".join(got["x"].to_pylist()), np.float32).reshape(got.num_rows, -1)
    return learn(x, got["y"].to_numpy(), rank, neighbours)


def classify(df: DataFrame, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_labelled: int = 4000, rank: int = 48, neighbours: int = 21, out: str = "quality_vote") -> DataFrame:
    """The rows of ``df`` with a struct ``out``: score (0 to 1).  ``docs`` holds the texts of the labelled ids."""
    voters = fit(docs, labels, id_col, text_col, label_col, max_labelled, rank, neighbours)
    base = df.drop(out)
    names = base.columns
    at = names.index(text_col)

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or "" for t in b.column(at).to_pylist()]
        score = np.full(len(texts), 0.5) if voters is None else np.concatenate([voters.scores(x) for x in chunks(texts)])
        made = pa.StructArray.from_arrays([pa.array(np.clip(score, 0, 1), pa.float64())], ["score"])
        return pa.RecordBatch.from_arrays([*b.columns, made], [*names, out])

    return map_batches(base, batch, with_field(base.schema, out, "struct<score:double>"))
