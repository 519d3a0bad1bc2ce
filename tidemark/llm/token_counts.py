"""Token counts by a compiled finite-state tokenizer.

The merges of a BPE vocabulary with word ends are compiled into a
deterministic transducer.  While it reads a word, a state keeps every token
that may still be under way: where it began, the last token before it and how
many tokens that prefix has.  Two adjacent tokens belong to the result exactly
if no merge ever crosses their joint, so one token at most ends at each symbol
and the state after a symbol is determined.  Transitions carry the change of
the token count (it can fall when symbols merge).  States and transitions are
made when first needed and kept in bounded tables.

A word longer than ``CHUNK`` symbols is read as chunks.  Each chunk is a map
from the state before it to the state after it and the tokens emitted; the
maps are composed by a prefix scan, and equal chunks share one map.  White
space resets the transducer, so the words of a text are independent and the
count of a known word is looked up by two hashes of 64 bits (``words``).

Null text counts as empty (0 tokens, 0 bytes).  Repeated rows are counted each.
Columns of the input other than the id and the text are ignored.
"""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words as W
from tidemark.llm.frames import map_batches, slices

CHUNK = 512
STATES = 250_000
KNOWN_WORDS = 1_000_000
CHARS = 1 << 20
END = "</w>"
NEVER = (None, 0)


def byte_symbols() -> list[str]:
    """The printable symbol of each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    shown = {b: chr(b) for b in plain}
    others = (b for b in range(256) if b not in shown)
    shown |= {b: chr(256 + i) for i, b in enumerate(others)}
    return [shown[b] for b in range(256)]


class Transducer:
    """Counts the tokens of one word; built from the vocabulary and its merges."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in spec["model"]["merges"]]
        self.special = tuple(t["content"] for t in spec["added_tokens"])
        self.rank = {pair: i for i, pair in enumerate(merges)}
        self.made = {}
        for i, (a, b) in enumerate(merges):
            self.made.setdefault(a + b, (i, a, b))
        plain = byte_symbols()
        self.names = [*plain, *(b + END for b in plain)]
        self.tokens = {*self.made, *self.names}
        self.prefixes = set()
        for t in self.tokens:
            body, end = (t[: -len(END)], True) if t.endswith(END) and len(t) > len(END) else (t, False)
            self.prefixes.update(body[:k] for k in range(1, len(body) + (not end)))
            self.prefixes.add(t)
        self.clear()

    def clear(self) -> None:
        self.start = (("", None, 0),)
        self.number = {self.start: 0}
        self.state = [self.start]
        self.moves: dict[int, tuple[int, int]] = {}
        self.joints: dict[tuple[str, str], bool] = {}

    def spine(self, token: str, side: int) -> list[tuple[str, float]]:
        """The parts that stand at one end of a token while it is being built, each with the rank of the merge that ends it."""
        out, until = [], float("inf")
        while True:
            out.append((token, until))
            if token not in self.made:
                return out
            until, token = self.made[token][0], self.made[token][side]

    def joint(self, left: str, right: str) -> bool:
        """No merge crosses from ``left`` to ``right`` while both are built.  Equal merges run from left to right."""
        key = (left, right)
        if (known := self.joints.get(key)) is None:
            rank, known = self.rank, True
            for a, a_end in self.spine(left, 2):
                for b, b_end in self.spine(right, 1):
                    r = rank.get((a, b))
                    if r is not None and r < a_end and r <= b_end:
                        known = False
            self.joints[key] = known
        return known

    def move(self, number: int, symbol: int) -> tuple[int, int]:
        """Make the transition: the next state, and the change of the count."""
        alive, ended, shown = [], None, self.names[symbol]
        for node, last, count in self.state[number]:
            node += shown
            if node in self.prefixes:
                if node in self.tokens and (last is None or self.joint(last, node)):
                    ended = (node, count + 1)
                alive.append((node, last, count))
        token, count = ended
        state = (*((n, t, c - count) for n, t, c in alive), ("", token, 0))
        if state not in self.number:
            self.number[state] = len(self.state)
            self.state.append(state)
        self.moves[number << 9 | symbol] = out = (self.number[state], count)
        return out

    def read(self, number: int, symbols: list[int]) -> tuple[int, int]:
        total, known, move = 0, self.moves.get, self.move
        for s in symbols:
            number, change = known(number << 9 | s) or move(number, s)
            total += change
        return number, total

    @staticmethod
    def symbols(word: str) -> list[int]:
        """Bytes; 256 is added to the last, which carries the word end."""
        out = list(word.encode("utf-8", "surrogatepass"))
        out[-1] += 256
        return out

    def count(self, word: str) -> int:
        symbols = self.symbols(word)
        if len(self.state) > STATES or len(self.joints) > 4 * STATES:
            self.clear()
        if len(symbols) <= CHUNK:
            return self.read(0, symbols)[1]
        shared: dict[tuple[int, ...], StateMap] = {}
        maps = []
        for i in range(0, len(symbols), CHUNK):
            chunk = tuple(symbols[i : i + CHUNK])
            maps.append(shared.setdefault(chunk, StateMap(self, chunk)))
        return prefix_scan(maps)[-1](0)[1]


class StateMap:
    """What a chunk does to a state: the state after it and the tokens emitted, for the states that are asked for."""

    def __init__(self, transducer: Transducer, chunk: tuple[int, ...]):
        self.run, self.known = lambda s: transducer.read(s, chunk), {}

    def __call__(self, state: int) -> tuple[int, int]:
        if state not in self.known:
            self.known[state] = self.run(state)
        return self.known[state]

    def then(self, other: StateMap) -> StateMap:
        out = object.__new__(StateMap)

        def run(state: int) -> tuple[int, int]:
            middle, a = self(state)
            end, b = other(middle)
            return end, a + b

        out.run, out.known = run, {}
        return out


def prefix_scan(maps: list[StateMap]) -> list[StateMap]:
    """Compositions of the first 1, 2, 3, ... maps, paired like a tree so that depth grows with the logarithm."""
    if len(maps) == 1:
        return maps
    pairs = [a.then(b) for a, b in zip(maps[::2], maps[1::2])]
    scanned = prefix_scan(pairs)
    out = [maps[0]]
    for i in range(1, len(maps)):
        out.append(scanned[i // 2] if i % 2 else scanned[i // 2 - 1].then(maps[i]))
    return out


@lru_cache(2)
def transducer(path: str) -> Transducer:
    return Transducer(path)


class Counter:
    """Counts of whole texts; words already met are looked up."""

    def __init__(self, path: str):
        self.transducer, self.known = transducer(path), {}

    def normal(self, text: str) -> str:
        if not text.isascii():
            if not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
            text = text.replace("İ", "i̇")  # the one letter whose lower case is two code points
        return text

    def counts(self, texts: list[str]) -> np.ndarray:
        special = self.transducer.special
        out = np.zeros(len(texts), np.int64)
        for lo, hi in slices([len(t) for t in texts], CHARS):
            cp = W.code_points([self.normal(t) if not any(s in t for s in special) else special[0].join(map(self.normal, self.split(t))) for t in texts[lo:hi]], special[:1])
            cp = W.lowered()[cp]
            done = 0  # texts of this slice that have ended
            for start, end in W.windows(cp, CHARS):
                part = cp[start:end]
                marks = self.word_counts(part)
                ends = np.flatnonzero(part == W.PIECE)
                sums = np.diff(np.concatenate([[0], np.cumsum(marks)[ends], [marks.sum()]])) if len(ends) else np.array([marks.sum()])
                for k, s in enumerate(sums):
                    if lo + done + k < hi:
                        out[lo + done + k] += s
                done += len(ends)
        return out

    def split(self, text: str) -> list[str]:
        for s in self.transducer.special[1:]:
            text = text.replace(s, self.transducer.special[0])
        return text.split(self.transducer.special[0])

    def word_counts(self, cp: np.ndarray) -> np.ndarray:
        """The tokens of each word, at its first code point; 1 for special strings."""
        out = (cp == W.SPECIAL).astype(np.int64)
        starts, ends = W.word_bounds(cp, keep_space=False)
        plain = cp[starts] < W.PIECE
        starts, ends = starts[plain], ends[plain]
        if not len(starts):
            return out
        first, back, one, two = W.distinct_words(cp, starts, ends)
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
        known, count = self.known, self.transducer.count
        values = np.empty(len(first), np.int64)
        for i, (key, proof, f) in enumerate(zip(one, two, first.tolist())):
            kept, v = known.get(key, NEVER)
            if kept != proof:
                v = count(W.text_of(cp, starts[f], ends[f]))
                known[key] = proof, v
            values[i] = v
        out[starts] = values[back]
        return out


@lru_cache(2)
def counter(path: str) -> Counter:
    return Counter(path)


def count_tokens(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048) -> DataFrame:
    """Per row: id, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (n_tokens > limit).

    ``tokenizer`` is the path of a BPE file with word ends; every worker reads it once.  One narrow stage, no shuffle."""

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or "" for t in b.column(1).to_pylist()]
        n = counter(tokenizer).counts(texts)
        return pa.RecordBatch.from_arrays([b.column(0), pa.array([len(t.encode("utf-8", "surrogatepass")) for t in texts], pa.int64()), pa.array(n), pa.array(n > limit)], [id_col, "n_bytes", "n_tokens", "over_limit"])

    kind = df.schema[id_col].dataType.simpleString()
    return map_batches(df.select(F.col(id_col), F.col(text_col).cast("string")), batch, f"`{id_col}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
