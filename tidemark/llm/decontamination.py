"""Benchmark decontamination with one FM-index per shard of documents.

A phrase is a window of ``window`` consecutive words of an item; an item of fewer
words (but not none) is one phrase as a whole.  A word of a document is hit if it
lies in an occurrence of a phrase.

1. Words.  Texts are lower-cased (A-Z) and cut into words on arrays of bytes.  Words get
   the number they have in the phrases' vocabulary: looked up by a 64-bit hash, then
   compared byte by byte.  Other words have no number.  A run of numbered words shorter
   than the shortest phrase can hold none and is not indexed.
2. Index.  The runs of a shard (whole documents, ``SHARD_WORDS`` indexed words or one
   longer document) stand in one sequence with a mark between them.  Its suffixes are
   sorted by doubling prefixes, marks being different from each other; the word before each
   suffix goes into a wavelet matrix, which answers how often a word stands before a row.
3. Search.  All phrases of one length are searched backwards together: each step narrows a
   phrase's rows by two rank queries, and phrases without rows left fall out.
4. Places.  Every ``SAMPLE``-th position and the first word of each run keep their place.
   Rows found walk back through the index until they meet one.
5. Spans.  Places and lengths become a mark per word; neighbouring hit words are one span.

Shards are cut inside the tasks that read the documents: one narrow stage, no shuffle, and a
lost task is simply run again.  Phrases come in passes of about ``PHRASE_BYTES`` of text, so
what a task holds of the items is bounded however many there are; a further pass goes over the same
rows in the same stage and adds to their spans.  (Items repeated word for word count once; a single
item larger than a pass is a pass of its own.)

Null and empty texts have no words and no hits.  Repeated rows are searched each.  Items with a null or
empty text have no phrase; an item without an id hits words but isn't listed; rows that share an item id are one item.
Without items, or without documents, nothing is hit.  Other columns of the input pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.llm import words as W
from tidemark.llm.frames import slices, small_batches, with_field

WINDOW = 10
SHARD_WORDS = 500_000
SHARD_DOCS = 16_384
SLICE_BYTES = 1 << 20
PHRASE_BYTES = 4 << 20
SAMPLE = 8
KIND = "struct<n_words: bigint, n_hit: bigint, spans: array<struct<first: bigint, last: bigint, start: bigint, stop: bigint>>, items: array<string>>"
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def cut(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes of all texts, starts and ends of their words, and the first word of each text (and one more)."""
    data = _LOWER[np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)]
    edge = np.diff(np.concatenate([[False], _WORD[data], [False]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    stops = np.cumsum([len(r) + 1 for r in raw])
    return data, starts, ends, np.concatenate([[0], np.searchsorted(starts, stops)])


def suffix_order(text: np.ndarray) -> np.ndarray:
    """The starts of all suffixes in order.  Zeros are marks, each different from all others and smaller than words; the last entry is one."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    first = np.ones(n, bool)
    first[1:] = (text[order][1:] != text[order][:-1]) | (text[order][1:] == 0)
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    known = 1
    while True:
        rows = np.flatnonzero(~(first & np.append(first[1:], True)))
        if not len(rows):
            return order
        # suffixes that are equal so far hold no mark in what is known, so they go on after it
        at = order[rows]
        key = rank[at] * n + rank[at + known]
        by = np.argsort(key, kind="stable")
        order[rows], key = at[by], key[by]
        fresh = np.concatenate([[True], key[1:] != key[:-1]])
        first[rows] = fresh
        rank[order[rows]] = np.maximum.accumulate(np.where(fresh, rows, 0))
        known *= 2


class Wavelet:
    """Rank and access over a sequence of numbers, one array of counts per bit."""

    def __init__(self, values: np.ndarray, top: int):
        self.n, self.ones = len(values), []
        for bit in reversed(range(max(1, top.bit_length()))):
            set_ = (values >> bit) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(set_)]).astype(np.int32))
            values = np.concatenate([values[set_ == 0], values[set_ == 1]])
        self.zeros = [self.n - int(o[-1]) for o in self.ones]
        self.begin = self.follow(np.arange(top + 1), np.zeros(top + 1, np.int64))

    def follow(self, value: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Where the first ``row`` entries end among those that share all bits of ``value``."""
        for k, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            up = ones[row]
            row = np.where((value >> (len(self.ones) - 1 - k)) & 1, zeros + up, row - up)
        return row

    def rank(self, value: np.ndarray, row: np.ndarray) -> np.ndarray:
        """How often ``value`` stands before ``row``."""
        return self.follow(value, row) - self.begin[value]

    def access(self, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The value at ``row`` and how often it stands before."""
        value = np.zeros(len(row), np.int64)
        for ones, zeros in zip(self.ones, self.zeros):
            up = ones[row]
            set_ = ones[row + 1] - up
            value = value << 1 | set_
            row = np.where(set_, zeros + up, row - up)
        return value, row - self.begin[value]


class Index:
    """FM-index of one shard: ``text`` holds word numbers from 1 to ``top``, runs begin and the text ends with a 0."""

    def __init__(self, text: np.ndarray, top: int):
        place = suffix_order(text)
        self.before = Wavelet(text[place - 1], top)
        self.start = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=top + 1))])
        kept = (place % SAMPLE == 0) | (text[place - 1] == 0)
        self.kept, self.place = kept, place[kept]
        self.number = np.cumsum(kept) - 1

    def rows(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the phrases (one per line) that occur: their numbers, and the first row and the one after the last."""
        alive = np.arange(len(phrases))
        lo, hi = self.start[phrases[:, -1]], self.start[phrases[:, -1] + 1]
        for k in reversed(range(phrases.shape[1])):
            if k < phrases.shape[1] - 1:
                word = phrases[alive, k]
                lo, hi = self.start[word] + self.before.rank(word, lo), self.start[word] + self.before.rank(word, hi)
            found = lo < hi
            alive, lo, hi = alive[found], lo[found], hi[found]
            if not len(alive):
                break
        return alive, lo, hi

    def places(self, rows: np.ndarray) -> np.ndarray:
        """Positions of suffixes given by their rows."""
        out, steps = np.empty(len(rows), np.int64), np.zeros(len(rows), np.int64)
        todo = np.arange(len(rows))
        rows = rows.copy()
        while len(todo):
            met = self.kept[rows[todo]]
            done = todo[met]
            out[done] = self.place[self.number[rows[done]]] + steps[done]
            todo = todo[~met]
            word, rank = self.before.access(rows[todo])
            rows[todo] = self.start[word] + rank
            steps[todo] += 1
        return out


class Phrases:
    """The windows of some items: their vocabulary, the distinct windows by length, and the items that hold each."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int):
        vocabulary: dict[bytes, int] = {}
        found: dict[tuple[int, ...], int] = {}
        self.items = sorted({i for i, _ in items if i is not None})
        number = {i: k for k, i in enumerate(self.items)}
        holds: list[tuple[int, int]] = []
        for item, text in items:
            data, starts, ends, _ = cut([(text or "").encode("utf-8", "surrogatepass")])
            data = data.tobytes()
            ids = [vocabulary.setdefault(data[a:b], len(vocabulary) + 1) for a, b in zip(starts.tolist(), ends.tolist())]
            for k in range(max(1, len(ids) - window + 1) if ids else 0):
                n = found.setdefault(tuple(ids[k : k + window]), len(found))
                if item is not None:
                    holds.append((n, number[item]))
        self.top = len(vocabulary)
        by_length: dict[int, list[tuple[tuple[int, ...], int]]] = {}
        for phrase, n in found.items():
            by_length.setdefault(len(phrase), []).append((phrase, n))
        self.lengths = {size: (np.array([p for p, _ in some]), np.array([n for _, n in some])) for size, some in by_length.items()}
        self.shortest = min(self.lengths, default=0)
        pairs = np.unique(np.array(holds, np.int64).reshape(-1, 2), axis=0)
        self.item_of = pairs[:, 1]
        self.item_at = np.searchsorted(pairs[:, 0], np.arange(len(found) + 1))
        known = list(vocabulary)
        self.sizes = np.array([0, *map(len, known)])
        self.at = np.cumsum(np.concatenate([[0], self.sizes[1:]])) if known else np.zeros(1, np.int64)
        self.letters = np.frombuffer(b"".join(known) + b"\0", np.uint8)
        hashes = W.word_hashes(self.letters, self.at[:-1], self.at[1:])[0] if known else np.zeros(0, np.uint64)
        self.by_hash = np.argsort(hashes, kind="stable")
        self.hashes = hashes[self.by_hash]
        self.equal = int(np.unique(hashes, return_counts=True)[1].max(initial=0))  # 1, but for words of one hash

    def numbers(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The vocabulary number of each word, 0 if it has none."""
        out = np.zeros(len(starts), np.int64)
        hashes = W.word_hashes(data, starts, ends)[0]
        row = np.searchsorted(self.hashes, hashes)
        for more in range(self.equal):
            here = np.flatnonzero((row + more < len(self.hashes)) & (out == 0))
            here = here[self.hashes[row[here] + more] == hashes[here]]
            number = self.by_hash[row[here] + more]
            same = self.sizes[number + 1] == ends[here] - starts[here]
            here, number = here[same], number[same]
            sizes = self.sizes[number + 1]
            until = np.cumsum(sizes)
            inside = np.arange(until[-1] if len(until) else 0) - np.repeat(until - sizes, sizes)
            differ = data[np.repeat(starts[here], sizes) + inside] != self.letters[np.repeat(self.at[number], sizes) + inside]
            wrong = np.zeros(len(here), bool)
            wrong[np.repeat(np.arange(len(here)), sizes)[differ]] = True
            out[here[~wrong]] = number[~wrong] + 1
        return out


class Shard:
    """Indexed words of some documents, until there are enough for one index."""

    def __init__(self, phrases: Phrases):
        self.phrases, self.n_words, self.parts, self.size = phrases, [], [], 0

    @property
    def full(self) -> bool:
        return self.size >= SHARD_WORDS or len(self.n_words) >= SHARD_DOCS

    def add(self, raw: list[bytes]) -> None:
        p = self.phrases
        data, starts, ends, bounds = cut(raw)
        document = np.repeat(np.arange(len(raw)), np.diff(bounds))
        if p.shortest:
            number = p.numbers(data, starts, ends)
            known = number > 0
            opens = known.copy()
            opens[1:] &= ~known[:-1] | (document[1:] != document[:-1])
            run = np.cumsum(opens) - 1
            long_enough = np.bincount(run[known], minlength=1) >= p.shortest
            kept = np.flatnonzero(known & long_enough[run]) if known.any() else np.zeros(0, np.int64)
            if len(kept):
                # bytes that only continue a character don't count in code points
                points = np.cumsum((data & 0xC0) != 0x80)
                text_at = np.concatenate([[0], np.cumsum([len(r) + 1 for r in raw])])[:-1][document[kept]]
                origin = points[text_at] - 1
                first = points[starts[kept]] - 1 - origin
                last = points[ends[kept] - 1] - origin
                self.parts.append((number[kept], opens[kept], document[kept] + len(self.n_words), kept - bounds[document[kept]], first, last))
                self.size += len(kept)
        self.n_words.extend(np.diff(bounds).tolist())

    def hits(self) -> list[tuple[list[tuple[int, int, int, int]], list[str]]]:
        """Spans and items of each document."""
        out: list[tuple[list[tuple[int, int, int, int]], list[str]]] = [([], []) for _ in self.n_words]
        if not self.parts:
            return out
        p = self.phrases
        number, opens, document, word, first, last = (np.concatenate(x) for x in zip(*self.parts))
        text = np.zeros(len(number) + int(opens.sum()) + 1, np.int64)
        place = np.arange(len(number)) + np.cumsum(opens)  # a mark stands before each run
        text[place] = number
        of = np.zeros(len(text), np.int64)
        of[place] = np.arange(len(number))
        index = Index(text, p.top)
        change = np.zeros(len(number) + 1, np.int64)
        met: list[np.ndarray] = []
        for size, (phrases, numbers) in p.lengths.items():
            alive, lo, hi = index.rows(phrases)
            many = hi - lo
            for a, b in slices(many.tolist(), SHARD_WORDS):
                n = many[a:b]
                rows = np.repeat(lo[a:b] - np.cumsum(n) + n, n) + np.arange(n.sum())
                at = of[index.places(rows)]
                np.add.at(change, at, 1)
                np.add.at(change, at + size, -1)
                met.append(np.unique(document[at] * len(p.item_at) + np.repeat(numbers[alive[a:b]], n)))
        hit = np.flatnonzero(np.cumsum(change[:-1]) > 0)
        if len(hit):
            fresh = np.concatenate([[True], (np.diff(document[hit]) != 0) | (np.diff(word[hit]) != 1)])
            ends = np.append(np.flatnonzero(fresh)[1:], len(hit)) - 1
            for a, b in zip(hit[fresh].tolist(), hit[ends].tolist()):
                out[document[a]][0].append((int(word[a]), int(word[b]) + 1, int(first[a]), int(last[b])))
            pairs = np.unique(np.concatenate(met))
            owner, phrase = np.divmod(pairs, len(p.item_at))
            n = p.item_at[phrase + 1] - p.item_at[phrase]
            items = p.item_of[np.repeat(p.item_at[phrase] - np.cumsum(n) + n, n) + np.arange(n.sum())]
            for d, i in np.unique(np.stack([np.repeat(owner, n), items], axis=1), axis=0).tolist():
                out[d][1].append(p.items[i])
        return out


def merged(spans: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Spans of several passes: those that overlap or touch are one."""
    out: list[tuple[int, int, int, int]] = []
    for s in sorted(spans):
        if out and s[0] <= out[-1][1]:
            a = out[-1]
            out[-1] = (a[0], max(a[1], s[1]), a[2], max(a[3], s[3]))
        else:
            out.append(s)
    return out


def passes(items: DataFrame, item_col: str, text_col: str, phrase_bytes: int) -> Iterator[list[tuple[str | None, str | None]]]:
    """Items in portions of about ``phrase_bytes`` of text; one portion at a time is on the driver."""
    rows = items.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text")).where("text <> ''").distinct()
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = -(-total // phrase_bytes)
    for k in range(parts):
        some = rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == k) if parts > 1 else rows
        yield [(r.item, r.text) for r in some.collect()]


def search(
    df: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, out: str = "contamination", phrase_bytes: int = PHRASE_BYTES
) -> DataFrame:
    """``df`` and a struct ``out``: ``n_words``, ``n_hit``, ``spans`` (word numbers ``first`` to ``last`` and code points ``start`` to ``stop``, each from 0
    and without the last) and ``items`` (ids as sorted strings).  A column named ``out`` is replaced."""
    spark = df.sparkSession
    df = df.drop(out)
    schema = with_field(df.schema, out, KIND)
    at = df.columns.index(text_col)
    kind = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("spans", pa.list_(pa.struct([(n, pa.int64()) for n in ("first", "last", "start", "stop")]))), ("items", pa.list_(pa.string()))])

    def one_pass(phrases, schema: StructType, add: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            shard, held = Shard(phrases.value), []

            def done() -> Iterator[pa.RecordBatch]:
                hits, row = shard.hits(), 0
                for b in held:
                    old = b.column(b.num_columns - 1).to_pylist() if add else [None] * b.num_rows
                    values = []
                    for k in range(b.num_rows):
                        spans, names = hits[row]
                        if old[k]:
                            spans = merged([*spans, *(tuple(s.values()) for s in old[k]["spans"])])
                            names = sorted({*names, *old[k]["items"]})
                        values.append((shard.n_words[row], sum(s[1] - s[0] for s in spans), [dict(zip(("first", "last", "start", "stop"), s)) for s in spans], names))
                        row += 1
                    columns = b.columns[: len(schema) - 1]
                    made = pa.array([dict(zip(("n_words", "n_hit", "spans", "items"), v)) for v in values], kind)
                    yield pa.RecordBatch.from_arrays([*columns, made], names=schema.names)

            for b in batches:
                if not b.num_rows:
                    continue
                raw = [t or b"" for t in b.column(at).cast(pa.string()).cast(pa.binary()).to_pylist()]
                for lo, hi in slices([len(r) for r in raw], SLICE_BYTES):
                    shard.add(raw[lo:hi])
                held.append(b)
                if shard.full:
                    yield from done()
                    shard, held = Shard(phrases.value), []
            if held:
                yield from done()

        return run

    found = df
    small_batches(spark)
    for k, some in enumerate(passes(items, item_col, item_text_col, phrase_bytes)):
        found = found.mapInArrow(one_pass(spark.sparkContext.broadcast(Phrases(some, window)), schema, k > 0), schema)
    if found is df:
        found = df.mapInArrow(one_pass(spark.sparkContext.broadcast(Phrases([], window)), schema, False), schema)
    return found


def without_spans(df: DataFrame, text_col: str = "text", found: str = "contamination") -> DataFrame:
    """The texts without the spans that ``search`` found."""
    spans = F.col(f"{found}.spans")
    parts = F.transform(
        F.sequence(F.lit(0), F.size(spans)),
        lambda k: F.substring(
            F.col(text_col),
            F.when(k == 0, 1).otherwise(F.get(spans, k - 1)["stop"] + 1).cast("int"),
            (F.when(k == F.size(spans), F.length(text_col)).otherwise(F.get(spans, k)["start"]) - F.when(k == 0, 0).otherwise(F.get(spans, k - 1)["stop"])).cast("int"),
        ),
    )
    return df.withColumn(text_col, F.when(F.size(spans) > 0, F.array_join(parts, "")).otherwise(F.col(text_col)))
