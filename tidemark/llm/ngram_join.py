"""Jaccard join on word n-grams by vertical partitioning.

A text's set holds the hashes of its distinct n-grams of words.  Texts with the
same set are one class, so copies are compared once.  The join finds all
pairs of classes whose sets overlap by ``percent`` of their union or more.

1. Frequencies.  The n-grams' hash space is cut into fragments of about
   ``FRAGMENT`` entries.  Each fragment counts on its own, from packed arrays, how
   many classes hold each n-gram; only n-grams of two classes or more go on.
2. Prefixes.  In the global order (frequency, then hash) two sets can only be similar
   if they share one of their first n - ceil(p n) + 1 n-grams.  N-grams of a single
   class come first and match nothing, so most classes have no prefix left and end here.
3. Blocks.  Each remaining class goes to the block of the most frequent n-gram of its
   prefix; blocks hold ``BLOCK_ROWS`` classes or ``BLOCK_GRAMS`` n-grams at most and are
   split beyond.  Pairs of blocks that share a prefix n-gram are compared, each by one task row.
4. Overlaps.  A pair of blocks cuts the n-grams they share, in global order, into
   fragments.  Partial overlaps of all its pairs are counted fragment by fragment and
   summed per pair; pairs that can't reach the bound any more fall out.  The sum is exact,
   every pair of classes is met once at most, and only a number of links and one local root
   per class leave the task, so no group is written out as pairs.

Sets of one text are told apart by 64 bits, n-grams inside a fragment by 40 bits and the
fragment's own: within one pair of texts a false match is about as likely as 1 in 10^8.

Null texts and texts without words have an empty set and link with nothing; with fewer
than n words the whole sequence is the one n-gram.  A null id takes part but is never the
smallest id.  Repeated rows are copies.  Only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words as W
from tidemark.llm.components import connected_components
from tidemark.llm.embedding_dedup import local_roots
from tidemark.llm.frames import map_batches, slices, small_batches
from tidemark.session import materialize

FRAGMENT = 8_000_000
MIN_FRAGMENTS = 32
LANE = 40
CHUNK = 1_000_000
BLOCK_ROWS, BLOCK_GRAMS = 512, 400_000
COLUMNS = 4096
BYTES = 1 << 20
U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_TURN = [U(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0xD6E8FEB86659FD93)]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def gram_sets(texts: list[str], n: int = 5) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each text."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    out: list[np.ndarray] = []
    for lo, hi in slices([len(r) for r in raw], BYTES):
        data = _LOWER[np.frombuffer(b"\n".join(raw[lo:hi]) + b"\n", np.uint8)]
        edge = np.diff(np.concatenate([[True], _SPACE[data], [True]]).astype(np.int8))
        starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        stops = np.cumsum([len(r) + 1 for r in raw[lo:hi]])
        bounds = np.concatenate([[0], np.searchsorted(starts, stops)])
        word = W.word_hashes(data, starts, ends)[0]
        grams = np.zeros(max(len(word) - n + 1, 0), U)
        for k in range(n if len(grams) else 0):
            grams += mix(word[k : k + len(grams)] * _TURN[k % 5] + U(k))
        grams = mix(grams)
        for a, b in zip(bounds[:-1], bounds[1:]):
            if b - a >= n:
                out.append(np.unique(grams[a : b - n + 1]))
            elif b > a:
                whole = np.array([b - a], U)
                for k in range(a, b):
                    whole = mix(whole * _TURN[0] ^ word[k : k + 1])
                out.append(whole)
            else:
                out.append(np.zeros(0, U))
    return out


def class_key(grams: np.ndarray) -> int:
    """The signed 64-bit key of a set."""
    return int(mix(mix(grams).sum(keepdims=True) + np.array([len(grams)], U) * _TURN[1]).view(np.int64)[0])


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    return n - (n * percent + 99) // 100 + 1


def keyed(df: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """Per row: id, key of its set (null if empty) and ``n_shingles``."""

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        sets = gram_sets([t or "" for t in b.column(1).to_pylist()], n)
        keys = [class_key(s) if len(s) else None for s in sets]
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(keys, pa.int64()), pa.array([len(s) for s in sets], pa.int64())], ["id", "key", "n_shingles"])

    kind = df.schema[id_col].dataType.simpleString()
    return map_batches(df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")), batch, f"id {kind}, key bigint, n_shingles bigint")


def fragments(df: DataFrame, text_col: str, n: int, bits: int) -> DataFrame:
    """Packed entries of every fragment: class keys, set sizes, entries per class, and the n-grams in 32 + 8 bits."""

    def pack(keys: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
        sizes = np.array([len(s) for s in sets])
        grams, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
        part = (grams >> U(64 - bits)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        grams, owner, part = grams[order], owner[order], part[order]
        lane = (grams >> U(64 - bits - LANE)) & U((1 << LANE) - 1)
        key = np.array(keys, np.int64)
        rows = []
        at = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        for s, e in zip(at, [*at[1:], len(part)]):
            new = np.flatnonzero(np.concatenate([[True], owner[s + 1 : e] != owner[s : e - 1]]))
            of = owner[s:e][new]
            counts = np.diff(np.append(new, e - s))
            rows.append((int(part[s]), key[of].tobytes(), sizes[of].astype(np.int32).tobytes(), counts.astype(np.int32).tobytes(), (lane[s:e] >> U(8)).astype(np.uint32).tobytes(), lane[s:e].astype(np.uint8).tobytes()))
        columns = list(zip(*rows))
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *[pa.array(c, pa.binary()) for c in columns[1:]]], ["frag", "keys", "sizes", "counts", "high", "low"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        keys, sets, held = [], [], 0
        for b in batches:
            for s in gram_sets([t or "" for t in b.column(0).to_pylist()], n):
                if len(s) and (k := class_key(s)) not in met:
                    met.add(k)
                    keys.append(k)
                    sets.append(s)
                    held += len(s)
                    if held >= CHUNK:
                        yield pack(keys, sets)
                        keys, sets, held = [], [], 0
        if keys:
            yield pack(keys, sets)

    small_batches(df.sparkSession)
    return df.select(F.col(text_col).cast("string")).mapInArrow(run, "frag int, keys binary, sizes binary, counts binary, high binary, low binary")


def shared_grams(packed: DataFrame, bits: int) -> DataFrame:
    """Per fragment, the n-grams that two classes or more hold, packed by class again and dealt to ``2**bits`` groups of classes."""
    groups = 1 << bits

    def count(t: pa.Table) -> pa.Table:
        def all_of(name: str, kind: str) -> np.ndarray:
            return np.frombuffer(b"".join(t[name].to_pylist()), kind)

        frag = t["frag"][0].as_py()
        key, size, counts = all_of("keys", "<i8"), all_of("sizes", "<i4"), all_of("counts", "<i4")
        lane = all_of("high", "<u4").astype(U) << U(8) | all_of("low", "u1").astype(U)
        _, first = np.unique(key, return_index=True)  # copies come from several tasks
        once = np.zeros(len(key), bool)
        once[first] = True
        owner = np.repeat(np.arange(len(key)), counts)
        kept = once[owner]
        lane, owner = lane[kept], owner[kept]
        order = np.argsort(lane, kind="stable")
        lane, owner = lane[order], owner[order]
        edge = np.flatnonzero(np.concatenate([[True], lane[1:] != lane[:-1]])) if len(lane) else np.zeros(0, int)
        df = np.repeat(np.diff(np.append(edge, len(lane))), np.diff(np.append(edge, len(lane)))) if len(lane) else np.zeros(0, int)
        many = df > 1
        lane, owner, df = lane[many] | U(frag) << U(LANE), owner[many], np.minimum(df[many], 65535).astype(np.uint16)
        group = (key[owner].astype(U) % U(groups)).astype(np.int32)
        order = np.lexsort((owner, group))
        lane, owner, df, group = lane[order], owner[order], df[order], group[order]
        rows = []
        at = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else []
        for s, e in zip(at, [*at[1:], len(group)]):
            new = np.flatnonzero(np.concatenate([[True], owner[s + 1 : e] != owner[s : e - 1]]))
            of = owner[s:e][new]
            rows.append((int(group[s]), key[of].tobytes(), size[of].tobytes(), np.diff(np.append(new, e - s)).astype(np.int32).tobytes(), lane[s:e].tobytes(), df[s:e].tobytes()))
        columns = list(zip(*rows)) if rows else [[]] * 6
        return pa.table([pa.array(columns[0], pa.int32()), *[pa.array(c, pa.binary()) for c in columns[1:]]], names=["grp", "keys", "sizes", "counts", "grams", "df"])

    return packed.groupBy("frag").applyInArrow(count, "grp int, keys binary, sizes binary, counts binary, grams binary, df binary")


def prefixes(shared: DataFrame, percent: int) -> DataFrame:
    """Classes with a prefix left: key, n, the prefix and all shared n-grams (as global numbers) with their frequencies."""

    def cut(t: pa.Table) -> pa.Table:
        def all_of(name: str, kind: str) -> np.ndarray:
            return np.frombuffer(b"".join(t[name].to_pylist()), kind)

        key, size, counts = all_of("keys", "<i8"), all_of("sizes", "<i4").astype(np.int64), all_of("counts", "<i4")
        gram, df = all_of("grams", "<u8"), all_of("df", "<u2")
        own, first, of = np.unique(key, return_index=True, return_inverse=True)
        n = size[first]
        owner = np.repeat(of, counts)
        m = np.bincount(owner, minlength=len(own))
        left = prefix_length(n, percent) - (n - m)
        order = np.lexsort((gram, df, owner))
        gram, starts = gram[order].astype(np.int64), np.concatenate([[0], np.cumsum(m)])
        kept = np.flatnonzero(left > 0)
        return pa.table(
            [pa.array(own[kept]), pa.array(n[kept]), pa.array([gram[starts[i] : starts[i] + left[i]] for i in kept], pa.list_(pa.int64())), pa.array([gram[starts[i] : starts[i + 1]].tobytes() for i in kept], pa.binary())],
            names=["key", "n", "prefix", "grams"],
        )

    return shared.groupBy("grp").applyInArrow(cut, "key bigint, n bigint, prefix array<bigint>, grams binary")


def overlapping(n_a: np.ndarray, a: list[np.ndarray], n_b: np.ndarray, b: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (index in a, index in b) whose sets overlap enough: partial overlaps by fragment of the n-grams in both, summed per pair."""
    flat_a, flat_b = np.concatenate(a), np.concatenate(b)
    both = np.intersect1d(flat_a, flat_b)
    own_a, own_b = np.repeat(np.arange(len(a)), [len(x) for x in a]), np.repeat(np.arange(len(b)), [len(x) for x in b])

    def places(flat: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(both, flat), max(len(both) - 1, 0))
        hit = both[at] == flat if len(both) else np.zeros(len(flat), bool)
        order = np.argsort(at[hit], kind="stable")
        return at[hit][order], own[hit][order], np.bincount(own[hit], minlength=own.max(initial=-1) + 1)

    at_a, of_a, left_a = places(flat_a, own_a)
    at_b, of_b, left_b = places(flat_b, own_b)
    left_a, left_b = np.pad(left_a, (0, len(a) - len(left_a))), np.pad(left_b, (0, len(b) - len(left_b)))
    need = -(-(percent * (n_a[:, None] + n_b)) // (100 + percent))  # |A and B| >= p / (1 + p) * (|A| + |B|)
    overlap = np.zeros((len(a), len(b)), np.float32)
    for lo in range(0, len(both), COLUMNS):
        sa, ea = np.searchsorted(at_a, [lo, lo + COLUMNS])
        sb, eb = np.searchsorted(at_b, [lo, lo + COLUMNS])
        xa, xb = np.zeros((len(a), min(COLUMNS, len(both) - lo)), np.float32), np.zeros((len(b), min(COLUMNS, len(both) - lo)), np.float32)
        xa[of_a[sa:ea], at_a[sa:ea] - lo] = 1
        xb[of_b[sb:eb], at_b[sb:eb] - lo] = 1
        overlap += xa @ xb.T
        left_a, left_b = left_a - np.bincount(of_a[sa:ea], minlength=len(a)), left_b - np.bincount(of_b[sb:eb], minlength=len(b))
        if not (overlap + np.minimum(left_a[:, None], left_b) >= need).any():
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.nonzero(overlap >= need)


def links(classes: DataFrame, percent: int) -> DataFrame:
    """Links of classes (key, n, copies, prefix, grams): per pair of blocks every linked class, the rows linked to it there
    and its local root, as (key, n_links, root)."""
    spark = classes.sparkSession
    entries = classes.select("key", F.size("prefix").alias("m"), F.octet_length("grams").alias("bytes"), F.explode("prefix").alias("gram"))
    held = entries.groupBy("gram").agg(F.count("*").alias("c")).where("c > 1")
    entries = materialize(entries.join(held, "gram"))
    home = entries.groupBy("key").agg(F.max(F.struct("c", "gram"))["gram"].alias("home"), F.first("bytes").alias("bytes"))
    sizes = home.groupBy("home").agg(F.greatest(F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum("bytes") / (8 * BLOCK_GRAMS))).cast("int").alias("parts"))
    block = F.xxhash64("home", F.pmod(F.xxhash64(F.lit(1), "key"), F.col("parts")))
    placed = materialize(home.join(sizes, "home").select("key", block.alias("block")))

    # which blocks meet: the distinct sets of blocks that share a prefix n-gram
    meet = entries.select("gram", "key").join(placed, "key").groupBy("gram").agg(F.array_sort(F.collect_set("block")).alias("blocks")).select("blocks").distinct()
    pairs = meet.select("blocks", F.posexplode("blocks").alias("i", "x")).select("x", F.explode(F.slice("blocks", F.col("i") + 1, F.size("blocks"))).alias("y")).distinct()

    def gather(t: pa.Table) -> pa.Table:
        grams = t["grams"].to_pylist()
        values = [t[c].to_numpy().tobytes() for c in ("key", "n", "copies")] + [np.array([len(g) // 8 for g in grams], np.int64).tobytes(), b"".join(grams)]
        return pa.table([t["block"].slice(0, 1), *[pa.array([v], pa.binary()) for v in values]], names=["block", *names])

    names = ["keys", "ns", "copies", "counts", "grams"]
    blocks = materialize(classes.select("key", "n", "copies", "grams").join(placed, "key").groupBy("block").applyInArrow(gather, "block bigint, " + ", ".join(f"{c} binary" for c in names)))
    side = lambda s: blocks.select(F.col("block").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in names])
    # a block with itself travels once
    joined = pairs.join(side("x"), "x").join(side("y"), "y").select(*[f"x_{c}" for c in names], *[F.when(F.col("x") != F.col("y"), F.col(f"y_{c}")).alias(f"y_{c}") for c in names])

    def unpack(keys: bytes, ns: bytes, copies: bytes, counts: bytes, grams: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
        at = np.cumsum(np.frombuffer(counts, np.int64))[:-1]
        return *(np.frombuffer(x, np.int64) for x in (keys, ns, copies)), np.split(np.frombuffer(grams, np.int64), at)

    def compare(b: pa.RecordBatch) -> pa.RecordBatch:
        found: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in range(3)]
        for row in zip(*[c.to_pylist() for c in b.columns]):
            key, n_a, copies, a = unpack(*row[:5])
            if row[5] is None:
                i, j = overlapping(n_a, a, n_a, a, percent)
                i, j = i[i < j], j[i < j]
            else:
                key_b, n_b, copies_b, other = unpack(*row[5:])
                i, j = overlapping(n_a, a, n_b, other, percent)
                j, key, copies = j + len(key), np.concatenate([key, key_b]), np.concatenate([copies, copies_b])
            if len(i):
                n = np.bincount(i, copies[j], len(key)) + np.bincount(j, copies[i], len(key))
                order = np.argsort(key)  # local roots are smallest keys
                back = np.empty(len(key), np.int64)
                back[order] = np.arange(len(key))
                root = local_roots(len(key), back[i], back[j])
                met = np.flatnonzero(n[order])
                for held, values in zip(found, (key[order][met], n[order][met].astype(np.int64), key[order][root[met]])):
                    held.append(values)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in found], ["key", "n_links", "root"])

    out = map_batches(joined, compare, "key bigint, n_links bigint, root bigint")
    small_batches(spark, 8)
    return out


def similar(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 80) -> DataFrame:
    """Per row: id, ``n_shingles``, ``component_id`` (the smallest id reachable over links) and ``n_links`` (other rows linked directly)."""
    docs = materialize(keyed(df, id_col, text_col, n))
    known = materialize(docs.where("key IS NOT NULL").groupBy("key").agg(F.first("n_shingles").alias("n"), F.count("*").alias("copies"), F.min("id").alias("least")))
    total = known.agg(F.sum("n")).first()[0] or 0
    bits = max(MIN_FRAGMENTS.bit_length() - 1, int(total // FRAGMENT).bit_length())
    classes = prefixes(shared_grams(fragments(df, text_col, n, bits), bits), percent)
    classes = materialize(classes.join(known.select("key", "copies"), "key"))
    met = materialize(links(classes, percent))
    small_batches(df.sparkSession)
    roots = connected_components(met.select(F.col("key").alias("a"), F.col("root").alias("b")))
    of = known.join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    of = of.join(met.groupBy("key").agg(F.sum("n_links").alias("n_links")), "key", "left")
    component = of.groupBy("root").agg(F.min("least").alias("component"))
    n_links = F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1
    of = of.join(component, "root").select("key", "component", n_links.alias("n_links"))
    return docs.join(of, "key", "left").select(F.col("id").alias(id_col), "n_shingles", F.coalesce("component", "id").alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
