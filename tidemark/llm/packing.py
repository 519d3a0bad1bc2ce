"""Packing by power-of-two decomposition.

A document's ids are cut into pieces whose lengths are powers of two: as many
pieces of the full length as fit, then the binary digits of the rest, longest
first.  Every piece is a sequence of its own, so no sequence crosses documents
and none needs padding; training reads sequences of one length (``bucket`` is
its logarithm) in a batch.

Ids come from the tokenizer library, word by word: texts are split by the
tokenizer's pattern on arrays (``words``), words already met are looked up by
two hashes of 64 bits, and only new words are encoded.  The end id closes every document, so an
empty or null text is one piece of one id.  Documents stay whole in one row
of one task; nothing is shuffled.  Sequence ids are unique and follow the rows
of the input partitions, so a lost task makes the same ids again as long as the
input is read in the same splits (a file scan, a checkpoint).
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import words as W
from tidemark.llm.frames import map_batches, slices
from tidemark.llm.token_counts import byte_symbols

LENGTH = 2048
CHARS = 1 << 20
KNOWN_WORDS = 400_000
NEVER = (None, b"")


def piece_lengths(n: int, length: int = LENGTH) -> list[int]:
    """Full pieces, then the binary digits of what is left, longest first."""
    rest = n % length
    return [length] * (n // length) + [1 << k for k in reversed(range(rest.bit_length())) if rest >> k & 1]


class Encoder:
    """Ids of whole texts, as little-endian 32-bit bytes, with ``end_id`` after each text."""

    def __init__(self, path: str, end_id: int):
        self.library = Tokenizer.from_file(path)
        self.model, self.shown = self.library.model, dict(enumerate(byte_symbols()))
        self.end = end_id.to_bytes(4, "little")
        added = self.library.get_added_tokens_decoder()
        self.special = tuple(t.content for t in added.values())
        if len(self.special) > 1:
            raise ValueError("one special string is supported")
        self.special_id = b"".join(int(i).to_bytes(4, "little") for i in added)
        self.known: dict[int, tuple[int, bytes]] = {}

    def ids(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for lo, hi in slices([len(t) for t in texts], CHARS):
            cp = W.code_points(texts[lo:hi], self.special)
            held: list[bytes] = []
            for start, end in W.windows(cp, CHARS):
                data, stops = self.encode(cp[start:end])
                at = 0
                for stop in stops.tolist():
                    held.append(data[at:stop])
                    out.append(b"".join(held))
                    held, at = [], stop
                held.append(data[at:])
        return out

    def encode(self, cp: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The ids of all words, marks included, and where the ids of each text that ends here stop (in bytes)."""
        starts, ends = W.word_bounds(cp, keep_space=True)
        first, back, one, two = W.distinct_words(cp, starts, ends)
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
        known, tokenize, shown = self.known, self.model.tokenize, self.shown
        values: list[bytes] = []
        for key, proof, f in zip(one, two, first.tolist()):
            kept, value = known.get(key, NEVER)
            if kept != proof:
                code = cp[starts[f]]
                if code >= W.PIECE:
                    value = self.end if code == W.PIECE else self.special_id
                else:
                    symbols = W.text_of(cp, starts[f], ends[f]).encode("utf-8", "surrogatepass").decode("latin-1").translate(shown)
                    value = b"".join([t.id.to_bytes(4, "little") for t in tokenize(symbols)])
                known[key] = proof, value
            values.append(value)
        pool = np.frombuffer(b"".join(values), np.uint32)
        sizes = np.fromiter(map(len, values), np.int64, len(values)) // 4
        places = (np.cumsum(sizes) - sizes)[back]  # where each word's ids begin in the pool
        sizes = sizes[back]
        until = np.cumsum(sizes)
        data = pool[np.repeat(places - until + sizes, sizes) + np.arange(until[-1] if len(until) else 0)]
        return data.tobytes(), 4 * until[cp[starts] == W.PIECE]


@lru_cache(2)
def encoder(path: str, end_id: int) -> Encoder:
    return Encoder(path, end_id)


def pack(df: DataFrame, tokenizer: str, end_id: int = 1, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, ``start``, ``length``, ``ids`` (32-bit values), ``doc_tokens``, ``sequence_id``, ``offset`` and ``bucket``.

    Repeated rows are packed each; a null id stays null.  ``length`` must be a power of two."""
    if length < 1 or length & (length - 1):
        raise ValueError("the length must be a power of two")

    def batch(b: pa.RecordBatch) -> pa.Table:
        rows, starts, lengths, ids, totals = [], [], [], [], []
        for i, data in enumerate(encoder(tokenizer, end_id).ids([t or "" for t in b.column(1).to_pylist()])):
            at, total = 0, len(data) // 4
            for n in piece_lengths(total, length):
                rows.append(i)
                starts.append(at)
                lengths.append(n)
                ids.append(data[4 * at : 4 * (at + n)])
                totals.append(total)
                at += n
        values = pa.Array.from_buffers(pa.int32(), sum(lengths), [None, pa.py_buffer(b"".join(ids))])
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), values)
        return pa.Table.from_arrays([b.column(0).take(pa.array(rows)), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), lists, pa.array(totals, pa.int64()), pa.array([zlib.crc32(x) for x in ids], pa.int64()), pa.array([n.bit_length() - 1 for n in lengths], pa.int32())], ["id", "start", "length", "ids", "doc_tokens", "ids_crc32", "bucket"])

    kind = df.schema[id_col].dataType.simpleString()
    out = map_batches(df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")), batch, f"id {kind}, start bigint, length bigint, ids array<int>, doc_tokens bigint, ids_crc32 bigint, bucket int")
    return out.select(F.col("id").alias(id_col), "start", "length", "ids", "ids_crc32", "doc_tokens", F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"), "bucket")
