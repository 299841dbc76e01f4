"""SimHash near-duplicates: pivot distance tables discard pairs, survivors are verified.

Every whole text gets a 64-bit SimHash of its word shingles. Fingerprints at `radius` or fewer differing bits are
linked. The search is exact: the 64 bits are cut into 2 * radius blocks, and two linked fingerprints agree on at
least `radius` whole blocks, so they meet under one of the keys made from `radius` blocks. Under a key, the Hamming
distances of all fingerprints to reference fingerprints (pivots) are tabled. Distances obey the triangle inequality:
a pair whose table rows differ by more than the radius in any coordinate cannot be linked and is discarded; the rest
is verified bit by bit. A key with many fingerprints is covered by pivots of its own, which link most of the group
without comparing its pairs, and a key over `task_rows` is dealt out as pairs of parts to many tasks.

Null and wordless texts have the fingerprint zero and are linked like any other. Each input row gives one result
row, repeated rows included; a null doc_id never names a component unless all of its rows have none.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderpulse.llm.common import id_and_text, mix64, pieces, record_batch, stored, text_bytes
from orderpulse.llm.components import connected_components

SEED = 42
PIVOTS = mix64(np.arange(1, 17, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
SMALL_GROUP = 64  # up to here, all pairs under a key go through the table
TASK_ROWS = 50_000
CHUNK = 1 << 14  # hashes whose bits are laid out at a time


def shingle_hashes(text: bytes, words: int) -> list[int]:
    """XXH64 of the space-joined shingles of the lower-cased text; fewer words make one shingle."""
    found = text.lower().split()  # on bytes: A-Z only, and white space is 0x20 and 0x09 to 0x0D
    if len(found) <= words:
        return [xxhash.xxh64_intdigest(b" ".join(found), SEED)] if found else []
    line = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.r_[0, ends[: len(found) - words] + 1]
    digest = xxhash.xxh64_intdigest
    return [digest(line[a:b], SEED) for a, b in zip(starts.tolist(), ends[words - 1 :].tolist())]


def majority_bits(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For runs of `counts` hashes: the bits that are set in over half of a run's hashes."""
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    ends = np.cumsum(counts[full])
    ones = np.zeros((len(full), 64), np.int64)
    for a in range(0, len(hashes), CHUNK):  # a sum makes eight bytes of each bit
        bits = np.unpackbits(hashes[a : a + CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        low = int(np.searchsorted(ends, a, side="right"))
        high = int(np.searchsorted(ends, a + len(bits) - 1, side="right")) + 1
        starts = np.maximum(np.r_[0, ends[:-1]][low:high] - a, 0)
        ones[low:high] += np.add.reduceat(bits, starts, axis=0, dtype=np.int64)
    over = (2 * ones > counts[full][:, None]).astype(np.uint8)
    out[full] = np.packbits(over, axis=1, bitorder="little").reshape(-1).view(np.uint64)
    return out


def text_key(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, key, fp) for every row; key is a hash that tells texts apart."""
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                hashes = [shingle_hashes(t, words) for t in text_bytes(part["text"])]
                counts = np.array([len(h) for h in hashes], np.int64)
                flat = np.fromiter((x for h in hashes for x in h), np.uint64, int(counts.sum()))
                fp = majority_bits(flat, counts).view(np.int64)
                yield record_batch(schema, [part["doc_id"], part["key"], fp])

    return id_and_text(docs).withColumn("key", text_key("text")).mapInArrow(run, "doc_id long, key long, fp long")


def block_masks(radius: int) -> list[int]:
    """Masks of the keys: every choice of `radius` out of 2 * radius blocks of bits."""
    if radius == 0:
        return [-1]
    cuts = [round(64 * i / (2 * radius)) for i in range(2 * radius + 1)]
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]
    masks = [sum(chosen) for chosen in combinations(blocks, radius)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


class Forest:
    """Links within one task: each node points to a node of its tree."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def link(self, i: int, others: np.ndarray) -> None:
        for j in others.tolist():
            a, b = self.root(i), self.root(j)
            self.up[max(a, b)] = min(a, b)

    def roots(self) -> np.ndarray:
        while (self.up[self.up] != self.up).any():
            self.up = self.up[self.up]
        return self.up


def links_in_large_group(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect all linked fingerprints of one group; pairs that share a component already are left out."""
    forest, covered = Forest(len(fps)), np.zeros(len(fps), bool)
    pivots = []
    while not covered.all():
        i = int(np.argmin(covered))
        away = distance(fps, fps[i])
        near = np.flatnonzero(away <= radius)
        covered[near] = True
        forest.link(i, near)
        if len(pivots) < 64:
            pivots.append(away.astype(np.int16))
    tables = np.stack(pivots, axis=1)
    roots = forest.roots()
    names, sizes = np.unique(roots, return_counts=True)
    largest = names[np.argmax(sizes)]
    for i in np.flatnonzero(roots != largest).tolist():
        other = np.flatnonzero(forest.roots() != forest.root(i))
        for k in range(tables.shape[1]):
            other = other[np.abs(tables[other, k] - tables[i, k]) <= radius]
        forest.link(i, other[distance(fps[other], fps[i]) <= radius])
    roots = forest.roots()
    moved = np.flatnonzero(roots != np.arange(len(fps)))
    return fps[moved], fps[roots[moved]]


def links(keys: np.ndarray, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges among fingerprints that lie next to each other under the same key."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[starts, len(keys)])
    a, b = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    for s, n in zip(starts[sizes > SMALL_GROUP], sizes[sizes > SMALL_GROUP]):
        x, y = links_in_large_group(fps[s : s + n], radius)
        a.append(x)
        b.append(y)
    left = np.flatnonzero(np.repeat((sizes > 1) & (sizes <= SMALL_GROUP), sizes))
    tables = distance(fps[:, None], PIVOTS[None, :]).astype(np.int16) if len(left) else None
    step = 1
    while len(left):
        left = left[left + step < len(keys)]
        left = left[keys[left] == keys[left + step]]
        pair = left
        for k in range(len(PIVOTS)):
            pair = pair[np.abs(tables[pair, k] - tables[pair + step, k]) <= radius]
        pair = pair[distance(fps[pair], fps[pair + step]) <= radius]
        a.append(fps[pair])
        b.append(fps[pair + step])
        step += 1
    return np.concatenate(a), np.concatenate(b)


def similar_fingerprints(distinct: DataFrame, radius: int = 3, task_rows: int = TASK_ROWS) -> DataFrame:
    """Edges (a, b) that connect exactly the distinct fingerprints `fp` linked by `radius` or fewer bits.

    Pairs that other edges of the same key connect may be missing; components are whole."""
    masks = F.array(*[F.struct(F.lit(i).alias("choice"), F.lit(m).alias("mask")) for i, m in enumerate(block_masks(radius))])
    rows = distinct.select("fp", F.explode(masks).alias("m"))
    rows = rows.select("fp", F.xxhash64(F.col("m.choice"), F.col("fp").bitwiseAND(F.col("m.mask"))).alias("key"))
    # A key over task_rows is cut into parts, and each pair of parts is a task's group of its own.
    hot = rows.groupBy("key").count().filter(F.col("count") > task_rows)
    hot = hot.select("key", F.ceil(F.col("count") / task_rows).cast("int").alias("parts"))
    rows = rows.join(hot, "key", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = F.pmod(F.xxhash64(F.lit(1), "fp"), F.col("parts")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda j: F.xxhash64("key", F.least(j, own), F.greatest(j, own)),
    )
    grouped = rows.select("fp", F.explode(pairs).alias("group")).filter(F.col("group").isNotNull())
    grouped = grouped.repartition("group").sortWithinPartitions("group", "fp")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            keys = np.concatenate([keys, batch["group"].to_numpy()])
            fps = np.concatenate([fps, batch["fp"].to_numpy().view(np.uint64)])
            if not len(keys):
                continue
            done = int(np.searchsorted(keys, keys[-1]))  # the last group may go on in the next batch
            a, b = links(keys[:done], fps[:done], radius)
            yield record_batch(schema, [a.view(np.int64), b.view(np.int64)])
            keys, fps = keys[done:], fps[done:]
        if len(keys):
            a, b = links(keys, fps, radius)
            yield record_batch(schema, [a.view(np.int64), b.view(np.int64)])

    return grouped.select("group", "fp").mapInArrow(run, "a long, b long").distinct()


def component_names(rows: DataFrame, radius: int = 3, task_rows: int = TASK_ROWS) -> DataFrame:
    """(fp, component_id) for the fingerprints of (doc_id, fp) rows."""
    return named_components(rows, connected_components(similar_fingerprints(rows.select("fp").distinct(), radius, task_rows)))


def named_components(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(fp, component_id, label) for the fp of (doc_id, fp) rows, given the (node, label) of those that have links."""
    distinct = rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    named = distinct.join(labels.withColumnRenamed("node", "fp"), "fp", "left")
    named = named.select("fp", "first_id", F.coalesce("label", "fp").alias("label"))
    smallest = named.groupBy("label").agg(F.min("first_id").alias("component_id"))
    return stored(named.join(smallest, "label").select("fp", "component_id", "label"), "components")


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 3, task_rows: int = TASK_ROWS) -> DataFrame:
    """(doc_id, fp, component_id) for every row; component_id is the smallest doc_id reachable over links."""
    rows = stored(fingerprints(docs, words), "fingerprints")
    return rows.join(component_names(rows, radius, task_rows), "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, words: int = 3, radius: int = 3, task_rows: int = TASK_ROWS) -> DataFrame:
    """Of each component the row with the smallest doc_id, with all columns; of rows that share it, one."""
    rows = stored(fingerprints(docs, words), "fingerprints")
    return one_of_each(docs, rows, connected_components(similar_fingerprints(rows.select("fp").distinct(), radius, task_rows)))


def one_of_each(docs: DataFrame, rows: DataFrame, labels: DataFrame) -> DataFrame:
    """The kept rows, given (doc_id, key, fp) of all rows and the (node, label) of each fp that has links."""
    names = named_components(rows, labels)
    named = rows.join(names, "fp").filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = named.groupBy("label").agg(F.min("key").alias("kept_key"), F.first("doc_id").alias("kept_id"))
    kept = kept.select(F.coalesce("kept_id", F.lit(-1)).alias("kept_id"), "kept_key")
    found = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("kept_id"), text_key("text").alias("kept_key"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
    )
    return found.join(kept, ["kept_id", "kept_key"]).dropDuplicates(["kept_id", "kept_key"]).select("row.*")


def hex_digits(fp: str) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
