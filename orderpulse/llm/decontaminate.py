"""Benchmark decontamination by SimHash windows of item size.

Words are compared lower-cased. A benchmark item of n words is looked for in all windows of n words of a text; a text of
fewer words is its own only window. Windows and items get a SimHash of their word shingles; the 64 bits are cut into
blocks, and a window is a candidate for an item if some block of the two differs by at most floor(radius / blocks) bits, which by the pigeonhole principle holds
for every fingerprint within the radius. Candidates within the radius are verified by the exact similarity of their
weighted shingles (sum of the smaller over sum of the larger multiplicities). Of the windows over the threshold that
overlap each other, the most similar one (then the first) is reported for an item.

A window that shares no shingle with any item has similarity zero, so only windows around shared shingles are
fingerprinted; this leaves no match out. The radius is twice what the angle of the threshold makes expected, but a
SimHash is a random projection: a window over the threshold may by chance lie beyond it.

Items are the query set: they are worked on in blocks of `item_block`, each held by every task, against all rows.
Null and wordless items match nothing, null texts hold nothing. Repeated rows are reported each.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderpulse.llm.common import id_and_text, record_batch
from orderpulse.llm.simhash import distance, majority_bits

WORDS = 5
SIMILARITY = 0.8
BLOCKS = 8
ITEM_BLOCK = 5_000

SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("item_id", pa.int64()), ("start_word", pa.int64()), ("n_words", pa.int64()),
     ("similarity", pa.float64()), ("distance", pa.int64())]
)
DDL = "doc_id long, item_id long, start_word long, n_words long, similarity double, distance long"


def expected_radius(similarity: float) -> int:
    """Twice the bits that are expected to differ at a multiset similarity, at most 32."""
    cosine = 2 * similarity / (1 + similarity)
    return min(32, math.ceil(2 * 64 * math.acos(cosine) / math.pi))


def split(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().split()


def shingles(words: list[bytes], size: int) -> list[bytes]:
    """The word shingles, repeats included; fewer words make one shingle."""
    if len(words) <= size:
        return [b" ".join(words)] if words else []
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.r_[0, ends[: len(words) - size] + 1]
    return [line[a:b] for a, b in zip(starts.tolist(), ends[size - 1 :].tolist())]


def similarity(a: Counter, b: Counter) -> float:
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def near_values(block_bits: int, within: int) -> np.ndarray:
    """All patterns of block_bits bits with at most `within` bits set."""
    flips = [sum(1 << i for i in chosen) for k in range(within + 1) for chosen in combinations(range(block_bits), k)]
    return np.array(flips, np.uint64)


class Index:
    """Items of one block of the query set, by length: their fingerprints in multi-index blocks, and their shingles."""

    def __init__(self, items: list[tuple[int, str | None]], size: int, radius: int):
        self.size, self.radius = size, radius
        self.items, self.by_shingle = [], defaultdict(set)
        by_length = defaultdict(list)
        for item_id, text in items:
            words = split(text)
            if not words:
                continue
            found = shingles(words, size)
            fp = majority_bits(np.array([xxhash.xxh64_intdigest(s, 42) for s in found], np.uint64), np.array([len(found)]))
            by_length[len(words)].append(len(self.items))
            for s in found:
                self.by_shingle[s].add(len(words))
            self.items.append((item_id, len(words), Counter(found), fp[0]))
        # A block agrees up to `within` bits: each value that a window's block can have lists the items it may match.
        self.bits = 64 // BLOCKS
        self.tables = {}
        for length, chosen in by_length.items():
            rows = [defaultdict(list) for _ in range(BLOCKS)]
            for i in chosen:
                for b in range(BLOCKS):
                    value = int(self.items[i][3]) >> (b * self.bits) & ((1 << self.bits) - 1)
                    for flip in near_values(self.bits, radius // BLOCKS).tolist():
                        rows[b][value ^ flip].append(i)
            self.tables[length] = rows
        self.short = sorted({n for n in by_length if n < size})

    def candidates(self, length: int, fps: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(window, item, distance) of all windows and items within the radius."""
        fps_list = fps.tolist()
        for w, fp in enumerate(fps_list):
            met = set()
            for b, rows in enumerate(self.tables[length]):
                met.update(rows.get(fp >> (b * self.bits) & ((1 << self.bits) - 1), ()))
            for i in met:
                away = (int(self.items[i][3]) ^ fp).bit_count()
                if away <= self.radius:
                    yield w, i, away

    def lengths(self, words: list[bytes], found: list[bytes]) -> dict[int, set[int]]:
        """For each item length, the starts of those windows that share a shingle with an item of this length."""
        starts = defaultdict(set)
        known = self.by_shingle
        for at, s in enumerate(found):
            if s in known:
                for n in known[s]:
                    if n > len(words) >= self.size:
                        starts[n].add(0)
                    elif n >= self.size:
                        starts[n].update(range(max(0, at + self.size - n), min(at, len(words) - n) + 1))
        for n in self.short:
            for at in range(len(words) - n + 1):
                if n in known.get(b" ".join(words[at : at + n]), ()):
                    starts[n].add(at)
        return starts

    def matches(self, text: str | None, threshold: float) -> list[tuple[int, int, int, float, int]]:
        words = split(text)
        found = shingles(words, self.size) if len(words) >= self.size else []
        if not self.short and self.by_shingle.keys().isdisjoint(found):
            return []
        hits = []
        for n, at in self.lengths(words, found).items():
            where = np.array(sorted(at), np.int64)
            for k in range(0, len(where), 2000):
                hits += self._verified(n, where[k : k + 2000], words, found, threshold)
        return _best(hits)

    def _verified(self, n: int, starts: np.ndarray, words: list[bytes], found: list[bytes], threshold: float) -> list:
        if n < self.size:
            grams, each = {a: [b" ".join(words[a : a + n])] for a in starts.tolist()}, 1
        else:
            each = min(n, len(words)) - self.size + 1
            grams = {a: found[a : a + each] for a in starts.tolist()}
        digests = {s: xxhash.xxh64_intdigest(s, 42) for g in grams.values() for s in g}
        flat = np.fromiter((digests[s] for g in grams.values() for s in g), np.uint64, each * len(starts))
        fps = majority_bits(flat, np.full(len(starts), each, np.int64))
        out = []
        for w, i, away in self.candidates(n, fps):
            a = int(starts[w])
            alike = similarity(Counter(grams[a]), self.items[i][2])
            if alike >= threshold:
                out.append((self.items[i][0], a, min(n, len(words)), alike, away))
        return out


def _best(hits: list[tuple[int, int, int, float, int]]) -> list[tuple[int, int, int, float, int]]:
    """Of overlapping windows of an item only the most similar, then the first."""
    out, taken = [], defaultdict(list)
    for hit in sorted(hits, key=lambda h: (h[0] is None, h[0] or 0, -h[3], h[1])):
        item, start, n = hit[:3]
        if all(start + n <= a or b <= start for a, b in taken[item]):
            taken[item].append((start, start + n))
            out.append(hit)
    return out


def _blocks(benchmark: DataFrame, item_block: int) -> Iterator[list[tuple[int, str | None]]]:
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    block = []
    for row in items.distinct().toLocalIterator():
        block.append((row["item_id"], row["text"]))
        if len(block) == item_block:
            yield block
            block = []
    if block:
        yield block


def matches(
    docs: DataFrame, benchmark: DataFrame, words: int = WORDS, threshold: float = SIMILARITY, item_block: int = ITEM_BLOCK
) -> DataFrame:
    """One row per document and place that holds a benchmark item."""
    rows, radius = id_and_text(docs), expected_radius(threshold)
    out = rows.sparkSession.createDataFrame([], DDL)
    for items in _blocks(benchmark, item_block):

        def run(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            index = Index(items, words, radius)
            for batch in batches:
                found = [
                    (doc_id, *hit)
                    for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist())
                    for hit in index.matches(text, threshold)
                ]
                yield record_batch(SCHEMA, list(zip(*found)) if found else [[]] * len(SCHEMA))

        out = out.union(rows.mapInArrow(run, DDL))
    return out


def without_matches(
    docs: DataFrame, benchmark: DataFrame, words: int = WORDS, threshold: float = SIMILARITY, item_block: int = ITEM_BLOCK
) -> DataFrame:
    """The rows of documents that hold no benchmark item, with all their columns."""
    radius = expected_radius(threshold)
    for items in _blocks(benchmark, item_block):

        def run(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            index = Index(items, words, radius)
            for batch in batches:
                yield batch.filter(pa.array([not index.matches(t, threshold) for t in batch["text"].to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
