"""Removal of long repeated byte strings by expansion of suffix intervals on a Burrows-Wheeler transform.

Every byte covered by a string of `length` bytes that also starts anywhere else in the table is removed. The search is
exact and runs in these steps, none of which gathers a group without a bound:

1. Anchors. In every window of `length` bytes the q-gram of least hash is an anchor. Equal windows choose equal anchors
   at the same place, so a repeated string lies in the contexts of anchors that occur at least twice; all others go.
2. Contexts. An anchor's context is made up of the windows that chose it. Equal contexts are counted before
   the shuffle; a context that occurs twice is repeated as a whole, and its windows need no further look.
3. Buckets. Different contexts of the same anchor are compared in buckets of bounded size (`bucket_rows`). There a
   Burrows-Wheeler transform of the contexts is built, and intervals of suffixes are extended backward, breadth first:
   when all strings of k bytes have been extended by one byte, the boundaries between neighbouring suffixes that
   become visible have a common prefix of exactly k. This derives common prefixes by increasing value and stops at
   `length`: boundaries that are still unset separate suffixes that share `length` bytes or more.
4. An anchor with more contexts than a bucket holds is dealt out to many buckets. A window that is repeated inside one
   is settled there. Each bucket also reports the hash of each different window once, with the window's places if they
   are unique so far, and windows of the same hash in two buckets settle each other.

Rows are known by doc_id and a hash of the text, so repeated rows and null ids are handled like any other: identical
texts repeat each other. Null texts are empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderpulse.llm.common import id_and_text, pieces, record_batch, stored, text_bytes

LENGTH = 200
BUCKET_ROWS = 4_000
CHUNK = 1 << 22
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SPREAD = np.uint64(0xD6E8FEB86659FD93)
_PLACE = np.uint64((1 << 24) - 1)


@lru_cache(2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2**64, and of its inverse."""
    out = []
    for base in (_BASE, _INVERSE):
        power = np.full(n, base)
        power[:1] = 1
        out.append(np.cumprod(power))
    return out[0], out[1]


def gram_hashes(data: np.ndarray, q: int, size: int = CHUNK) -> np.ndarray:
    """A hash of the q bytes at every place."""
    n = len(data)
    power, back = _powers(max(size + 4096, n))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:n], out=sums[1:])
    code = (sums[q:] - sums[: n - q + 1]) * back[: n - q + 1] * _SPREAD
    return (code ^ code >> np.uint64(32)) * _BASE


def least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least key of each window of `width` keys."""
    n = len(keys)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = keys
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def anchors(texts: list[bytes], length: int, q: int) -> tuple[np.ndarray, ...]:
    """Text, place, first byte, end and hash of every anchor: the windows that chose it make up [first byte, end)."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    begins = ends - sizes
    stops = np.repeat(ends, sizes)
    places, starts, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for start in range(0, max(0, len(data) - length + 1), CHUNK):
        part = data[start : start + CHUNK + length - 1]
        grams = gram_hashes(part, q)
        keys = grams & ~_PLACE | np.arange(len(grams), dtype=np.uint64)
        place = (least(keys, length - q + 1) & _PLACE).astype(np.int64)
        windows = np.arange(start, start + len(place))
        inside = stops[start : start + len(place)] - windows >= length
        place, windows = place[inside], windows[inside]
        places.append(place + start)
        starts.append(windows)
        hashes.append(grams[place])
    place, window, code = np.concatenate(places), np.concatenate(starts), np.concatenate(hashes)
    new = np.flatnonzero(np.r_[True, place[1:] != place[:-1]]) if len(place) else place
    last = window[np.r_[new[1:], len(place)] - 1] if len(place) else place
    owner = np.searchsorted(ends, place[new], side="right")
    shift = begins[owner]
    return owner, place[new] - shift, window[new] - shift, last + length - shift, code[new]


def suffix_array(data: np.ndarray, longest: int) -> np.ndarray:
    """Order of the suffixes, by their first 8 bytes, then doubling until all differ; `longest` bounds common prefixes."""
    n, k = len(data), 8
    key = np.zeros(n, np.uint64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    for i in range(8):
        key = key << np.uint64(8) | padded[i : n + i]
    order = np.argsort(key, kind="stable")
    while True:
        key = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.r_[True, key[1:] != key[:-1]])
        if rank.max(initial=0) == n or k > longest:
            return order
        key = rank * (n + 1)
        key[: max(0, n - k)] += rank[k:]
        order = np.argsort(key, kind="stable")
        k *= 2


def unset_boundaries(data: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """For each suffix in order: whether it shares `length` bytes with the one before it.

    Holds for neighbours that both have `length` bytes before the next separator (byte 0)."""
    n = len(data)
    bwt = data[order - 1]
    unset = np.ones(n + 1, bool)
    unset[[0, n]] = False
    occ = np.argsort(bwt, kind="stable")
    step = np.empty(n, np.int64)  # a row's row after putting its transform byte in front
    step[occ] = np.arange(n)
    runs = np.cumsum(np.r_[True, bwt[1:] != bwt[:-1]])
    low, size = np.zeros(1, np.int64), np.array([n])
    for _ in range(length):
        alike = runs[low] == runs[low + size - 1]
        mixed_low, mixed_size = low[~alike], size[~alike]
        rows = np.arange(int(mixed_size.sum())) + np.repeat(mixed_low - (np.cumsum(mixed_size) - mixed_size), mixed_size)
        of = np.repeat(np.arange(len(mixed_low)), mixed_size)
        _, first, count = np.unique(of << 8 | bwt[rows], return_index=True, return_counts=True)
        first = rows[first]  # where a byte first precedes the interval's string
        first, size = np.concatenate([low[alike], first]), np.concatenate([size[alike], count])
        real = bwt[first] != 0
        low, size = step[first[real]], size[real]
        new = unset[low + size]
        low, size = low[new], size[new]
        if not len(low):
            break
        unset[low + size] = False
        _, once = np.unique(low + size, return_index=True)
        low, size = low[once], size[once]
    return unset[:n]


def repeated_windows(contexts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Context, place and class of every window; windows with the same bytes have the same class."""
    text = b"\0".join([c.translate(_UP) for c in contexts]) + b"\0"
    data = np.frombuffer(text, np.uint8)
    sizes = np.array([len(c) + 1 for c in contexts], np.int64)
    order = suffix_array(data, 2 * int(sizes.max(initial=0)))
    same = unset_boundaries(data, order, length)
    ends = np.cumsum(sizes)
    left = np.repeat(ends, sizes) - 1 - np.arange(len(data))
    whole = left[order] >= length
    owner = np.repeat(np.arange(len(contexts)), sizes)[order[whole]]
    new = ~(same & np.r_[False, whole[:-1]])  # a shorter suffix in between also parts two windows
    return owner, order[whole] - (ends - sizes)[owner], np.cumsum(new[whole])


_UP = bytes(min(255, b + 1) for b in range(256))  # UTF-8 has no byte 255, which leaves byte 0 as a separator

SPANS = "doc long, key long, start long, stop long"


def _rows(docs: DataFrame) -> DataFrame:
    """doc and key of every row, and its text as bytes."""
    text = F.coalesce("text", F.lit(""))
    return id_and_text(docs).select(
        "doc_id", F.coalesce("doc_id", F.lit(-1)).alias("doc"), F.xxhash64(text).alias("key"), text.cast("binary").alias("text")
    )


def anchor_table(docs: DataFrame, length: int) -> DataFrame:
    names = ("doc", "key", "first", "stop", "anchor", "context")
    schema = pa.schema([(c, pa.int64()) for c in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                texts = text_bytes(part["text"])
                owner, place, first, stop, code = anchors(texts, length, max(1, length // 2))
                digest = xxhash.xxh3_64_intdigest
                context = [
                    digest(texts[o][a:b], p - a)
                    for o, p, a, b in zip(owner.tolist(), place.tolist(), first.tolist(), stop.tolist())
                ]
                ids = [part[c].to_numpy()[owner] for c in ("doc", "key")]
                context = np.array(context, np.uint64).view(np.int64)
                yield record_batch(schema, [*ids, first, stop, code.view(np.int64), context])

    return _rows(docs).select("doc", "key", "text").mapInArrow(run, ", ".join(f"{c} long" for c in names))


def _in_bucket(table: pa.Table, length: int) -> pa.Table:
    """Repeated spans of the bucket's contexts; of contexts dealt out to several buckets, one row per window class."""
    contexts = table["text"].to_pylist()
    owner, place, group = repeated_windows(contexts, length)
    _, index, count = np.unique(group, return_inverse=True, return_counts=True)
    often = count[index] > 1
    doc, key, first, dealt = (table[c].to_numpy() for c in ("doc", "key", "first", "dealt"))
    out = {c: [] for c in ("doc", "key", "start", "stop", "high", "low")}

    def add(rows: np.ndarray, start: np.ndarray, stop: np.ndarray, windows: list[int] | None = None) -> None:
        for name, values in (("doc", doc[rows]), ("key", key[rows]), ("start", start), ("stop", stop)):
            out[name] += values.tolist()
        out["high"] += [None] * len(rows) if windows is None else [(w >> 64) - (1 << 63) for w in windows]
        out["low"] += [None] * len(rows) if windows is None else [(w & (2**64 - 1)) - (1 << 63) for w in windows]

    at = np.lexsort((place[often], owner[often]))
    rows, start = owner[often][at], place[often][at]
    if len(rows):  # windows that overlap or touch make one span
        head = np.r_[True, (rows[1:] != rows[:-1]) | (start[1:] > start[:-1] + length)]
        tail = np.r_[head[1:], True]
        add(rows[head], first[rows[head]] + start[head], first[rows[head]] + start[tail] + length)
    if dealt.any():
        _, one = np.unique(group, return_index=True)
        one = one[dealt[owner[one]]]
        windows = [xxhash.xxh3_128_intdigest(contexts[o][p : p + length]) for o, p in zip(owner[one].tolist(), place[one].tolist())]
        begin = first[owner[one]] + place[one]
        add(owner[one], begin, np.where(often[one], begin, begin + length), windows)
    schema = pa.schema([(c, pa.int64()) for c in out])
    return pa.table([pa.array(out[c], pa.int64()) for c in out], schema=schema)


def repeated_spans(docs: DataFrame, length: int = LENGTH, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(doc, key, start, stop): spans, possibly overlapping, that make up all repeated bytes."""
    every = stored(anchor_table(docs, length), "anchors")
    often = every.groupBy("anchor").count().filter("count > 1").select("anchor")
    some = stored(every.join(often, "anchor"), "repeated-anchors")
    place = F.struct("doc", "key", "first", "stop").alias("place")
    kinds = some.groupBy("anchor", "context").agg(F.count("*").alias("n"), F.min(place).alias("place"))
    kinds = stored(kinds, "contexts")
    whole = some.join(kinds.filter("n > 1").select("anchor", "context"), ["anchor", "context"]).select(
        "doc", "key", F.col("first").alias("start"), "stop"
    )
    groups = kinds.groupBy("anchor").count().filter("count > 1")
    parts = F.ceil(F.col("count") / bucket_rows).cast("int")
    mixed = stored(kinds.join(groups.select("anchor", parts.alias("parts")), "anchor"), "mixed-contexts")
    buckets = max(1, -(-mixed.count() // bucket_rows))
    own = F.xxhash64("anchor", F.pmod(F.xxhash64("context"), F.col("parts")))
    mixed = mixed.select(
        "place.*", F.when(F.col("parts") > 1, own).otherwise(F.pmod(own, F.lit(buckets))).alias("bucket"),
        (F.col("parts") > 1).alias("dealt"),
    )
    cut = F.substr(F.col("text"), (F.col("first") + 1).cast("int"), (F.col("stop") - F.col("first")).cast("int"))
    once = _rows(docs).select("doc", "key", "text").join(mixed, ["doc", "key"])
    once = once.select("doc", "key", "first", "bucket", "dealt", cut.alias("text")).dropDuplicates(["doc", "key", "first"])
    found = once.groupBy("bucket").applyInArrow(lambda t: _in_bucket(t, length), SPANS + ", high long, low long")
    found = stored(found, "spans")
    apart = found.filter("high IS NOT NULL")
    shared = apart.groupBy("high", "low").count().filter("count > 1").select("high", "low")
    met = apart.filter("stop > start").join(shared, ["high", "low"])
    columns = ("doc", "key", "start", "stop")
    return whole.union(found.filter("high IS NULL").select(*columns)).union(met.select(*columns))


def without_repeats(docs: DataFrame, length: int = LENGTH, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes) for every row."""
    spans = repeated_spans(docs, length, bucket_rows).distinct()
    spans = spans.groupBy("doc", "key").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    rows = _rows(docs).join(spans, ["doc", "key"], "left")
    starts, stops = (F.col(f"spans.{c}").alias(c) for c in ("start", "stop"))
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                out = []
                for text, start, stop in zip(*(part[c].to_pylist() for c in ("text", "start", "stop"))):
                    kept, removed, runs, last = [], 0, 0, -1
                    for a, b in sorted(zip(start or (), stop or ())):
                        if a > last:  # a gap
                            kept.append(text[max(last, 0) : a])
                            runs, removed, last = runs + 1, removed + b - a, b
                        elif b > last:
                            removed, last = removed + b - last, b
                    kept.append(text[max(last, 0) :])
                    out.append((len(text), removed, runs, b"".join(kept)))
                yield record_batch(schema, [part["doc_id"], *(zip(*out) if out else [[]] * 4)])

    return rows.select("doc_id", "text", starts, stops).mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    )
