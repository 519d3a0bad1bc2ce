"""Language identification with interpolated Kneser-Ney character models.

Texts are lower-cased, anything but letters becomes one space, and characters
are packed four to a 64-bit key.  Per language the counts of distinct 4-grams
give all lower orders (continuation counts), the discounts and the interpolation
weights.  The model is a few sorted key arrays with one column of log
probabilities per language, small enough to travel with the tasks: it is fitted
on distinct texts chosen by their hash until about ``max_chars`` characters per
language are reached (the documented bound).  Texts longer than a twentieth of it
are drawn in pieces of that length, and copies count once.

Every whole text is scored in all languages; the lowest cross-entropy per
character wins, ties go to the first language by code point.  A quarter of the
fitting sample is kept apart to calibrate rejection, but never the first text of a
language, so every labelled language with a letter is learned: a text is rejected
if its best cross-entropy lies clearly above what texts of that language show.

Null texts and texts without a letter are ``und`` with score 0 and are rejected.
With no labelled text at all, every text is ``und``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words as W
from tidemark.llm.frames import map_batches, slices, with_field
from tidemark.session import materialize

ORDER = 4
BITS = 16
BLANK = 0x20
CHARS = 1 << 19
MASKS = [np.uint64((1 << BITS * n) - 1) for n in range(ORDER + 1)]
FAR = 0xFFFF  # letters beyond the basic plane share one value


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The 4-gram key that ends at each kept character, the text it belongs to, and which texts have a letter."""
    cp = W.lowered()[W.code_points(texts)]
    marks = np.flatnonzero(cp == W.PIECE)
    owner = np.repeat(np.arange(len(texts)), np.diff(np.concatenate([[-1], marks])))
    letter = W.classes()[cp] == W.LETTER
    c = np.where(letter, np.minimum(cp, FAR), BLANK).astype(np.uint64)
    kept = letter.copy()
    kept[1:] |= letter[:-1] & ~letter[1:] & (cp[1:] != W.PIECE)
    c, owner = c[kept], owner[kept]
    n = len(c)
    place = np.arange(n) - np.searchsorted(owner, owner, side="left") if n else np.zeros(0, np.int64)
    key = c.copy()
    for back in range(1, ORDER):
        before = np.full(n, np.uint64(BLANK))
        before[back:] = c[:-back] if n > back else before[back:]
        before[place < back] = BLANK
        key |= before << np.uint64(BITS * back)
    return key, owner, np.bincount(owner, minlength=len(texts)) > 0


@dataclass
class Model:
    """Sorted keys and log probabilities (key x language) of each order; log interpolation weights of each context."""

    languages: list[str]
    keys: list[np.ndarray]
    logs: list[np.ndarray]
    contexts: list[np.ndarray]
    weights: list[np.ndarray]
    floor: np.ndarray
    limits: np.ndarray | None = None

    def log_probabilities(self, key: np.ndarray, order: int = ORDER) -> np.ndarray:
        if order == 0:
            return np.broadcast_to(self.floor, (len(key), len(self.languages)))
        key = key & MASKS[order]
        at, found = find(self.keys[order], key)
        out = self.logs[order][at]
        if len(missing := np.flatnonzero(~found)):
            out[missing] = self.log_probabilities(key[missing], order - 1)
            context = key[missing] >> np.uint64(BITS)
            at, found = find(self.contexts[order], context)
            out[missing] += np.where(found[:, None], self.weights[order][at], 0)
        return out

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Nats per character (text x language) and characters of each text."""
        out, n = np.full((len(texts), len(self.languages)), np.inf), np.zeros(len(texts), np.int64)
        for lo, hi in slices([len(t) for t in texts], max(1 << 16, CHARS * 8 // max(8, len(self.languages)))):
            key, owner, has = grams(texts[lo:hi])
            if not len(key):
                continue
            sums = np.zeros((hi - lo, len(self.languages)))
            for a in range(0, len(key), CHARS):
                part, own = self.log_probabilities(key[a : a + CHARS]), owner[a : a + CHARS]
                first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
                sums[own[first]] += np.add.reduceat(part, first, axis=0, dtype=np.float64)
            n[lo:hi] = np.bincount(owner, minlength=hi - lo)
            out[lo:hi][has] = -sums[has] / n[lo:hi][has, None]
        return out, n


def find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def kneser_ney(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
    """The model from distinct 4-grams and their counts per language."""
    languages = sorted(counts)
    by_order: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(ORDER + 1)]
    for name in languages:
        keys, n = counts[name]
        for order in range(ORDER, 0, -1):
            by_order[order].append((keys, n.astype(np.float64)))
            keys, n = np.unique(keys & MASKS[order - 1], return_counts=True)
    union = [np.unique(np.concatenate([k for k, _ in o])) if o else np.zeros(0, np.uint64) for o in by_order]
    symbols = len(union[1]) + 1
    floor = np.full(len(languages), -np.log(symbols))
    logs, contexts, weights = [np.zeros((0, len(languages)))], [np.zeros(0, np.uint64)], [np.zeros((0, len(languages)))]
    lower = None
    for order in range(1, ORDER + 1):
        keys = union[order]
        around = np.unique(keys >> np.uint64(BITS))
        p, w = np.empty((len(keys), len(languages))), np.ones((len(around), len(languages)))
        for i in range(len(languages)):
            own, n = by_order[order][i]
            ones, twos = (n == 1).sum(), (n == 2).sum()
            d = ones / (ones + 2 * twos) if ones and twos else 0.5
            at = np.searchsorted(around, own >> np.uint64(BITS))
            total, kinds = np.bincount(at, n, len(around)), np.bincount(at, minlength=len(around))
            seen = total > 0
            w[seen, i] = d * kinds[seen] / total[seen]
            mine = np.zeros(len(keys))
            mine[np.searchsorted(keys, own)] = n - d
            here = np.searchsorted(around, keys >> np.uint64(BITS))
            base = np.exp(floor[i]) if order == 1 else lower[np.searchsorted(union[order - 1], keys & MASKS[order - 1]), i]
            p[:, i] = np.where(seen[here], mine / np.maximum(total[here], 1), 0) + w[here, i] * base
        lower = p
        logs.append(np.log(p).astype(np.float32))
        contexts.append(around)
        weights.append(np.log(w).astype(np.float32))
    return Model(languages, union, logs, contexts, weights, floor.astype(np.float32))


def fit(train: DataFrame, text_col: str, lang_col: str, max_chars: int) -> Model | None:
    """``train``: rows with text and language.  Two passes: characters of distinct texts per language, then the sample, which is kept."""
    rows = train.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    length = max(1, max_chars // 20)
    starts = F.sequence(F.lit(1), F.greatest(F.length("text"), F.lit(1)), F.lit(length))
    pieces = rows.select("lang", "text", F.explode(starts).alias("start")).select("lang", F.substring("text", F.col("start"), F.lit(length)).alias("text"))
    pieces = pieces.where(F.col("text").rlike(r"\p{L}")).withColumn("h", F.xxhash64(F.lit(3), "text"))
    once = pieces.groupBy("lang", "h").agg(F.max(F.length("text")).alias("n"))
    sizes = {r["lang"]: (r["n"], r["first"]) for r in once.groupBy("lang").agg(F.sum("n").alias("n"), F.min("h").alias("first")).collect()}
    if not sizes:
        return None
    million = 1_000_000

    def by_lang(values: dict[str, int]) -> F.Column:
        return F.element_at(F.create_map(*[F.lit(x).cast(t) for k, v in values.items() for x, t in ((k, "string"), (v, "bigint"))]), F.col("lang"))

    share = by_lang({k: min(million, max_chars * million // max(n, 1)) for k, (n, _) in sizes.items()})
    first = F.col("h") == by_lang({k: h for k, (_, h) in sizes.items()})
    drawn = pieces.where((F.pmod("h", F.lit(million)) < share) | first).groupBy("lang", "h").agg(F.max("text").alias("text"))
    apart = (F.pmod(F.xxhash64(F.lit(4), "text"), F.lit(4)) == 0) & ~first
    sample = materialize(drawn.withColumn("apart", apart).repartition(max(8, rows.sparkSession.sparkContext.defaultParallelism)))

    def count(b: pa.RecordBatch) -> pa.Table:
        texts, langs = b.column(0).to_pylist(), b.column(1).to_pylist()
        parts = []
        for name in sorted(set(langs)):
            mine = [t for t, x in zip(texts, langs) if x == name]
            for lo, hi in slices([len(t) for t in mine], CHARS):
                key, _, _ = grams(mine[lo:hi])
                found, n = np.unique(key, return_counts=True)
                parts.append(pa.table({"lang": pa.array([name] * len(found), pa.string()), "key": pa.array(found.view(np.int64)), "n": pa.array(n)}))
        return pa.concat_tables(parts)

    def counts(texts: DataFrame) -> pa.Table:
        return map_batches(texts.select("text", "lang"), count, "lang string, key bigint, n bigint").groupBy("lang", "key").agg(F.sum("n").alias("n")).toArrow()

    counted = counts(sample.where(~F.col("apart")))
    missing = sorted(set(sizes) - set(counted["lang"].unique().to_pylist()))
    if missing:  # letters to Spark, none to the model: whatever else there is
        counted = pa.concat_tables([counted, counts(pieces.where(F.col("lang").isin(missing)))])
    if not counted.num_rows:
        return None
    names = np.array(counted["lang"].to_pylist())
    keys, n = counted["key"].to_numpy().view(np.uint64), counted["n"].to_numpy()
    found = {}
    for name in sorted(set(names.tolist())):
        mine = names == name
        order = np.argsort(keys[mine])
        found[name] = (keys[mine][order], n[mine][order])
    model = kneser_ney(found)

    def measure(b: pa.RecordBatch) -> pa.RecordBatch:
        h, _ = model.entropies(b.column(0).to_pylist())
        at = {x: i for i, x in enumerate(model.languages)}
        own = [float(h[i, at[x]]) if x in at and np.isfinite(h[i, at[x]]) else None for i, x in enumerate(b.column(1).to_pylist())]
        return pa.RecordBatch.from_arrays([b.column(1), pa.array(own, pa.float64())], ["lang", "h"])

    measured = map_batches(sample.where("apart").select("text", "lang"), measure, "lang string, h double").where("h IS NOT NULL")
    top = {r["lang"]: (r["top"], r["mid"]) for r in measured.groupBy("lang").agg(F.percentile_approx("h", 0.99).alias("top"), F.percentile_approx("h", 0.5).alias("mid")).collect()}
    widest = max([t + (t - m) for t, m in top.values()], default=-float(model.floor[0]))  # uncalibrated: worse than a blind guess
    model.limits = np.array([(top[x][0] + (top[x][0] - top[x][1])) if x in top else widest for x in model.languages]) + 0.25
    return model


def identify(df: DataFrame, train: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_chars: int = 3_000_000, out: str = "language") -> DataFrame:
    """The rows of ``df`` with a struct ``out``: lang_pred, score (0 to 1), entropy (nats per character) and rejected.

    Input columns are passed through; one named like ``out`` gives way."""
    model = fit(train, text_col, lang_col, max_chars)
    base = df.drop(out)
    names = base.columns
    at = names.index(text_col)

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or "" for t in b.column(at).to_pylist()]
        if model is None:
            h, n = np.full((len(texts), 1), np.inf), np.zeros(len(texts), np.int64)
        else:
            h, n = model.entropies(texts)
        best = h.argmin(axis=1)
        low = h[np.arange(len(h)), best]
        known = np.isfinite(low)
        with np.errstate(invalid="ignore"):
            odds = np.exp(-(h - low[:, None]) * np.minimum(n, 100)[:, None])
        score = np.where(known, 1 / np.where(known, odds.sum(axis=1), 1), 0.0)
        languages = [model.languages[i] if k else "und" for i, k in zip(best, known)] if model else ["und"] * len(texts)
        # a short text strays further from its language's usual entropy
        rejected = ~known if model is None else ~known | (low > model.limits[best] + 4 / np.sqrt(np.maximum(n, 1)))
        made = pa.StructArray.from_arrays([pa.array(languages, pa.string()), pa.array(score), pa.array(np.where(known, low, np.nan), from_pandas=True), pa.array(rejected)], ["lang_pred", "score", "entropy", "rejected"])
        return pa.RecordBatch.from_arrays([*b.columns, made], [*names, out])

    schema = with_field(base.schema, out, "struct<lang_pred:string,score:double,entropy:double,rejected:boolean>")
    return map_batches(base, batch, schema)
