"""MinHash near-duplicates: many universal hash minima with banding, signature verification and exact confirmation.

Two texts are linked if the sets of their word shingles share `percent` hundredths of their union or more.

0. SimHash, if a radius is given. Fingerprints of the sets that differ by that many bits or fewer are found with `simhash`'s
   pivot distance tables. These candidates and those of the stars below are confirmed on the whole sets together.
1. Signatures. For each of bands * rows universal hash functions, the least value over a set's shingles. Texts with the
   same set are one node from here on.
2. Banding. Sets that agree on all rows of a band share a bucket. With 24 bands of 5 rows, a pair just at 85 hundredths
   shares none with probability 8e-7; with 30 bands of 4 rows, one at 80 hundredths with probability 2e-7.
3. Stars. In each bucket every set is paired with one leader only, so that pairs stay in proportion to sets. Signatures
   that agree five standard deviations less than linked ones should are discarded; the rest is confirmed on the whole
   sets, a leader's text being sent once for many partners.
4. Components of the confirmed links, by alternating large-star and small-star. Buckets that lie within one component are
   settled. Links of the next step are added to these components, not to the links behind them.
5. Rest. Sets of buckets that still hold several components are compared by size classes and ordered prefixes. Linked
   sets of sizes a and b share `percent` / (100 + percent) * (a + b) shingles, so that all but that many, plus one, of
   each set's shingles, the rare ones first, must have one in common. The prefix is so much shorter for a given class of
   partner sizes that pages of one template, which share frequent shingles, meet only if they can be linked. Only pairs
   of different components are confirmed. The order of shingles comes from a table of counts of fixed size over all of
   these sets; it has no effect on the result.

Shingles and sets are told apart by 64-bit hashes. Null and wordless texts have the empty set, which is linked with
nothing, or with its like if `link_empty`. Repeated rows are linked. A null doc_id never names a component unless all of
its rows have none. An empty table gives an empty result. Columns other than doc_id and text are passed by.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderpulse.llm.common import Scratch, id_and_text, mix64, pieces, record_batch, text_bytes
from orderpulse.llm.simhash import majority_bits, shingle_hashes, similar_fingerprints, text_key
from orderpulse.llm.stars import components

WORDS = 5
PERCENT = 85
BANDS, ROWS = 24, 5
PARTNERS = 500  # partners of one leader in a task, on average
COUNTERS = 1 << 18  # of the table that orders shingles
BITMAP_BITS = 24
CLASS = 1.05  # sizes of one class differ by this factor at most
CHUNK = 1 << 15  # shingles hashed at a time
PIECE = 1 << 20  # bytes of text that are signed at a time: 64 bits of each shingle are laid out as bytes


def shingle_set(text: bytes, words: int) -> np.ndarray:
    return np.unique(np.array(shingle_hashes(text, words), np.uint64))


def minima(sets: list[np.ndarray], hashes: int) -> np.ndarray:
    """For each set the upper half of the least a * x + b (modulo 2**64) for each hash function; empty sets get the maximum."""
    draws = mix64(np.arange(1, 2 * hashes + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    factors, shifts = draws[:hashes] | np.uint64(1), draws[hashes:]
    out = np.full((len(sets), hashes), np.iinfo(np.uint64).max, np.uint64)
    sizes = np.array([len(s) for s in sets], np.int64)
    full = np.flatnonzero(sizes)
    for first in range(0, len(full), 512):
        some = full[first : first + 512]
        flat, ends = np.concatenate([sets[i] for i in some]), np.cumsum(sizes[some])
        for a in range(0, len(flat), CHUNK):  # small enough to stay in the processor's cache
            part = flat[a : a + CHUNK]
            low = int(np.searchsorted(ends, a, side="right"))
            high = int(np.searchsorted(ends, a + len(part) - 1, side="right")) + 1
            starts = np.maximum(np.r_[0, ends[:-1]][low:high] - a, 0)
            rows = some[low:high]
            for k in range(hashes):
                out[rows, k] = np.minimum(out[rows, k], np.minimum.reduceat(part * factors[k] + shifts[k], starts))
    return (out >> np.uint64(32)).astype(np.uint32)


def signatures(docs: DataFrame, words: int, hashes: int, simhash: bool = False) -> DataFrame:
    """(doc_id, key, fp, size, signature, bits) for every row; key tells texts apart, fp sets of shingles, and bits is the SimHash
    of a set, or 0 if it is not asked for."""
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("fp", pa.int64()), ("size", pa.int64()), ("signature", pa.binary()),
                        ("bits", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, size=PIECE):
                sets = [shingle_set(t, words) for t in text_bytes(part["text"])]
                sizes = np.array([len(s) for s in sets], np.int64)
                fp = np.array([xxhash.xxh64_intdigest(s.tobytes(), 42) for s in sets], np.uint64).view(np.int64)
                found = [x.tobytes() if len(s) else None for x, s in zip(minima(sets, hashes), sets)]
                bits = majority_bits(np.concatenate(sets), sizes).view(np.int64) if simhash else np.zeros(len(sets), np.int64)
                yield record_batch(schema, [part["doc_id"], part["key"], fp, sizes, found, bits])

    rows = id_and_text(docs).withColumn("key", text_key("text"))
    return rows.mapInArrow(run, "doc_id long, key long, fp long, size long, signature binary, bits long")


def band_keys(sets: DataFrame, bands: int, rows: int) -> DataFrame:
    """(band, fp) for each band of each distinct set; band is a hash of the band's number and minima."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            found = np.frombuffer(b"".join(batch["signature"].to_pylist()), np.uint32).reshape(n, bands, rows).astype(np.uint64)
            keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (n, bands))
            for k in range(rows):
                keys = mix64(keys * np.uint64(0x9E3779B97F4A7C15) + found[:, :, k])
            fp = np.repeat(batch["fp"].to_numpy(), bands)
            yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1).view(np.int64)), pa.array(fp)], ["band", "fp"])

    return sets.select("fp", "signature").mapInArrow(run, "band long, fp long")


def likely(pairs: DataFrame, sets: DataFrame, percent: int, hashes: int) -> DataFrame:
    """The pairs (a, b) whose signatures agree no less than five standard deviations below `percent`."""
    share = percent / 100
    least = hashes * (share - 5 * (share * (1 - share) / hashes) ** 0.5)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch[c].to_pylist()), np.uint32).reshape(-1, hashes) for c in ("x", "y"))
            same = (x == y).sum(axis=1) if len(x) else np.zeros(0)
            yield batch.select(["a", "b"]).filter(pa.array(same >= least))

    side = lambda node, name: sets.select(F.col("fp").alias(node), F.col("signature").alias(name))
    both = pairs.join(side("a", "x"), "a").join(side("b", "y"), "b")
    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def texts_of(wanted: DataFrame, sets: DataFrame, docs: DataFrame) -> DataFrame:
    """`wanted` (fp, ...) with a text that has the set.

    Texts that nobody wants are dropped where they are read, by a bitmap of 2 MB at every size of the data. A text may
    pass it by chance; the join then drops it."""
    named = wanted.join(sets.select("fp", "doc", "key"), "fp")
    mask, word_bits = (1 << BITMAP_BITS) - 1, 1 << 13
    bits = named.select(F.col("key").bitwiseAND(F.lit(mask)).alias("bit")).distinct()
    words = bits.groupBy(F.floor(F.col("bit") / word_bits).alias("word")).agg(F.collect_set(F.col("bit") % word_bits).alias("bits"))
    held = np.zeros(1 << BITMAP_BITS, bool)
    for r in words.toLocalIterator():
        held[r["word"] * word_bits + np.array(r["bits"], np.int64)] = True
    packed = np.packbits(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch["key"].to_numpy() & mask
            yield batch.filter(pa.array((packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)))

    rows = id_and_text(docs).select(F.coalesce("doc_id", F.lit(-1)).alias("doc"), text_key("text").alias("key"), "text")
    rows = rows.mapInArrow(run, "doc long, key long, text string")
    return named.join(rows, ["doc", "key"]).drop("doc", "key")


def confirmed(pairs: DataFrame, sets: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The distinct pairs (a, b) whose whole sets share `percent` hundredths of their union."""
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / PARTNERS).alias("parts"))
    dealt = pairs.join(parts, "a").withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts")))
    heads = dealt.select("a", "part", F.col("a").alias("fp"), F.lit(0).alias("role")).distinct()
    wanted = heads.union(dealt.select("a", "part", F.col("b").alias("fp"), F.lit(1).alias("role")))
    # Rows that share an id and a text are one text here.
    rows = texts_of(wanted, sets, docs).repartition("a", "part").sortWithinPartitions("a", "part", "role", "fp")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, own, last = None, None, None
        for batch in batches:
            for piece in pieces(batch):
                linked = []
                names = zip(*(piece[c].to_pylist() for c in ("a", "part", "fp", "role")))
                for (a, part, fp, role), text in zip(names, text_bytes(piece["text"])):
                    if (a, part, fp) == last:
                        continue
                    last = a, part, fp
                    found = shingle_set(text, words)
                    if role == 0:
                        head, own = (a, part), found
                    elif head == (a, part):
                        shared = len(np.intersect1d(own, found, assume_unique=True))
                        if 100 * shared >= percent * (len(own) + len(found) - shared):
                            linked.append((a, fp))
                yield record_batch(schema, list(zip(*linked)) or [[], []])

    return rows.select("a", "part", "fp", "role", "text").mapInArrow(run, "a long, b long")


def least_shared(total, percent: int):
    """The shingles that two sets of `total` shingles together share at least if they are linked."""
    return -(-percent * total // (100 + percent))


def partner_classes(size: int, percent: int) -> Iterator[tuple[int, int]]:
    """The size classes of possible partners of a set, with the length of the prefix that it must show to each."""
    low, high = -(-percent * size // 100), 100 * size // percent
    for c in range(int(log(low) / log(CLASS) + 1e-9), int(log(high) / log(CLASS) + 1e-9) + 1):
        smallest = max(low, ceil(CLASS**c - 1e-6))
        length = size - least_shared(size + smallest, percent) + 1
        if length > 0:
            yield c, length


def prefixes(some: DataFrame, sets: DataFrame, docs: DataFrame, words: int, percent: int, scratch: Scratch) -> DataFrame:
    """(group, fp, size, place, side) of the ordered prefixes of the sets `some`; a group is a shingle and two size classes."""
    texts = scratch.store(texts_of(some, sets, docs).dropDuplicates(["fp"]), "texts", "zstd")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for part in pieces(batch):
                found = [shingle_set(t, words) for t in text_bytes(part["text"])]
                total += np.bincount((np.concatenate(found) % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["counter", "n"])

    found = texts.select("text").mapInArrow(count, "counter long, n long").groupBy("counter").agg(F.sum("n").alias("n"))
    held = found.toPandas()
    counts = np.zeros(COUNTERS, np.uint16)
    counts[held["counter"].to_numpy(np.int64)] = np.minimum(held["n"].to_numpy(np.int64), np.iinfo(np.uint16).max)
    schema = pa.schema([("group", pa.int64()), ("fp", pa.int64()), ("size", pa.int64()), ("place", pa.int64()), ("side", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                out = [[] for _ in schema]
                for fp, text in zip(part["fp"].to_pylist(), text_bytes(part["text"])):
                    shingles = shingle_set(text, words)
                    size = len(shingles)
                    order = np.lexsort((shingles, counts[(shingles % np.uint64(COUNTERS)).astype(np.int64)]))
                    shingles, own = shingles[order], int(log(size) / log(CLASS) + 1e-9)
                    for c, length in partner_classes(size, percent):
                        pair = np.array([min(own, c) << 32 | max(own, c)], np.uint64)
                        group = mix64(shingles[:length] ^ mix64(pair)).view(np.int64)
                        for column, x in zip(out, (group, np.full(len(group), fp), np.full(len(group), size), np.arange(len(group)),
                                                   np.full(len(group), (c > own) - (c < own)))):
                            column.append(x)
                yield record_batch(schema, [np.concatenate(c) if c else [] for c in out])

    return texts.select("fp", "text").mapInArrow(run, "group long, fp long, size long, place long, side long")


def met(group, fp, size, place, side, label, percent: int) -> np.ndarray:
    """Pairs of different components within each group that may be linked by their sizes and places in the prefixes."""
    out = [np.zeros((0, 2), np.int64)]
    left, step = np.arange(len(group)), 1
    while len(left):
        left = left[left + step < len(group)]
        left = left[group[left] == group[left + step]]
        other = left + step
        near = (label[left] != label[other]) & (side[left] == -side[other])
        at, to = left[near], other[near]
        needed = least_shared(size[at] + size[to], percent)
        shared = np.minimum(size[at] - place[at], size[to] - place[to]) + np.minimum(place[at], place[to])  # not more
        # Linked sets also meet within the prefixes for their very sizes, which are shorter than those for a class.
        possible = (shared >= needed) & (place[at] <= size[at] - needed) & (place[to] <= size[to] - needed)
        out.append(np.unique(np.stack([fp[at[possible]], fp[to[possible]]], axis=1), axis=0))
        step += 1
    return np.concatenate(out)


def meetings(rows: DataFrame, percent: int) -> DataFrame:
    """`met` for all groups: distinct pairs (a, b)."""
    names = ("group", "fp", "size", "place", "side", "label")
    rows = rows.repartition("group").sortWithinPartitions("group", "fp").select(*names)
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            new = [batch[c].to_numpy() for c in names]
            held = new if held is None else [np.concatenate(x) for x in zip(held, new)]
            if not len(held[0]):
                continue
            done = int(np.searchsorted(held[0], held[0][-1]))  # the last group may go on in the next batch
            yield record_batch(schema, list(met(*[x[:done] for x in held], percent).T))
            held = [x[done:] for x in held]
        if held is not None and len(held[0]):
            yield record_batch(schema, list(met(*held, percent).T))

    found = rows.mapInArrow(run, "a long, b long")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def open_buckets(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of the buckets that hold several components, with their label."""
    rows = buckets.join(labels.withColumnRenamed("node", "fp"), "fp", "left")
    rows = rows.withColumn("label", F.coalesce("label", "fp"))
    some = rows.groupBy("band").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x < y").select("band")
    return rows.join(some, "band")


def simhash_pairs(sets: DataFrame, radius: int) -> DataFrame:
    """Pairs (a, b) of sets whose SimHashes differ by `radius` bits or fewer, by pivot distance tables.

    Sets of one SimHash are paired with the least of them, and these with each other along the links of their SimHashes."""
    first = sets.groupBy("bits").agg(F.min("fp").alias("a"))
    alike = sets.join(first, "bits").select("a", F.col("fp").alias("b"))
    heads = lambda bits, name: first.select(F.col("bits").alias(bits), F.col("a").alias(name))
    near = similar_fingerprints(first.select(F.col("bits").alias("fp")), radius).select(F.col("a").alias("x"), F.col("b").alias("y"))
    near = near.join(heads("x", "a"), "x").join(heads("y", "b"), "y").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return alike.filter("a <> b").union(near).distinct()


def linked_sets(
    docs: DataFrame, sets: DataFrame, words: int, percent: int, bands: int, rows: int, radius: int | None, scratch: Scratch
) -> DataFrame:
    """(node, label) of the components of linked sets; a component's least node and sets without a link are left out."""

    def linked(pairs: DataFrame) -> DataFrame:
        """The pairs whose whole sets are linked."""
        pairs = scratch.store(likely(pairs, sets, percent, bands * rows), "pairs")
        found = scratch.store(confirmed(pairs, sets, docs, words, percent), "links")
        scratch.free(pairs)
        return found

    every = scratch.store(band_keys(sets, bands, rows), "bands")
    shared = every.groupBy("band").agg(F.count("*").alias("members")).filter("members > 1")
    buckets = scratch.store(every.join(shared, "band"), "buckets")
    scratch.free(every)
    # A set close to what many others have in common is in many large buckets, and makes a good leader.
    central = buckets.groupBy("fp").agg(F.sum("members").alias("central"))
    old, buckets = buckets, scratch.store(buckets.drop("members").join(central, "fp"), "buckets")
    scratch.free(old)
    leaders = buckets.groupBy("band").agg(F.min_by("fp", F.struct(-F.col("central"), F.col("fp"))).alias("a"))
    pairs = buckets.join(leaders, "band").filter("a <> fp").select("a", F.col("fp").alias("b"))
    if radius is not None:
        pairs = pairs.union(simhash_pairs(sets, radius))
    labels = components(linked(pairs.distinct()), scratch)
    crowded = scratch.store(open_buckets(buckets, labels).select("fp", "label").distinct(), "open")
    if crowded.isEmpty():
        return labels
    first = prefixes(crowded.select("fp"), sets, docs, words, percent, scratch).join(crowded, "fp")
    links = linked(scratch.store(meetings(first, percent), "met"))
    if links.isEmpty():
        return labels
    return components(links.union(labels.select(F.col("label").alias("a"), F.col("node").alias("b"))), scratch)


def near_duplicates(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS, link_empty: bool = False,
    radius: int | None = None,
) -> DataFrame:
    """(doc_id, key, n_shingles, component, component_id) for every row: component_id is the smallest doc_id reachable over
    links, itself included, and component tells components apart, also those without an id. With a radius, SimHash looks
    for links as well; the result is the same."""
    scratch = Scratch(docs.sparkSession)
    found = scratch.store(signatures(docs, words, bands * rows, radius is not None), "signatures")
    place = F.min(F.struct(F.coalesce("doc_id", F.lit(-1)).alias("doc"), "key")).alias("place")
    sets = found.filter("size > 0").groupBy("fp")
    sets = sets.agg(F.first("signature").alias("signature"), F.first("bits").alias("bits"), place, F.min("doc_id").alias("first_id"))
    sets = scratch.store(sets.select("fp", "signature", "bits", "place.*", "first_id"), "sets")
    labels = linked_sets(docs, sets, words, percent, bands, rows, radius, scratch)
    named = sets.select("fp", "first_id").join(labels.withColumnRenamed("node", "fp"), "fp", "left")
    named = named.select("fp", "first_id", F.coalesce("label", "fp").alias("component"))
    smallest = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = scratch.store(named.join(smallest, "component").select("fp", "component", "component_id"), "components")
    out = found.select("doc_id", "key", "fp", F.col("size").alias("n_shingles")).join(named, "fp", "left").drop("fp")
    empty_id = F.lit(found.filter("size = 0").agg(F.min("doc_id")).first()[0]) if link_empty else F.col("doc_id")
    component_id = F.when(F.col("n_shingles") == 0, empty_id.cast("long")).otherwise(F.col("component_id"))
    scratch.free_all_but(found, named)
    return out.select("doc_id", "key", "n_shingles", "component", component_id.alias("component_id"))


def keep_one(docs: DataFrame, words: int = WORDS, percent: int = 80, bands: int = 30, rows: int = 4, radius: int | None = 3) -> DataFrame:
    """Of each component the row with the smallest doc_id, with all columns; of rows that share it, one. Empty texts are alike.

    Links are looked for by SimHash within `radius` bits, if any, and by MinHash."""
    found = near_duplicates(docs, words, percent, bands, rows, link_empty=True, radius=radius)
    least = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = least.groupBy("component", (F.col("n_shingles") == 0).alias("empty"))
    kept = kept.agg(F.min("key").alias("kept_key"), F.first("doc_id").alias("kept_id"))
    place = lambda doc: [F.coalesce(doc, F.lit(0)).alias("kept_id"), doc.isNull().alias("no_id")]
    kept = kept.select(*place(F.col("kept_id")), "kept_key")
    rows_of = docs.select(
        *place(F.col("doc_id").cast("long")), text_key("text").alias("kept_key"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
    )
    names = ["kept_id", "no_id", "kept_key"]
    return rows_of.join(kept, names).dropDuplicates(names).select("row.*")


ORACLE = """
WITH RECURSIVE texts AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
sets AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) <= 5 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS shingle FROM texts),
sizes AS (SELECT t.doc_id, count(shingle) AS n FROM texts t LEFT JOIN sets USING (doc_id) GROUP BY ALL),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM sets x JOIN sets y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id
    GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * shared.n >= 85 * (x.n + y.n - shared.n)),
reached AS (SELECT doc_id, doc_id AS other FROM texts UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other),
found AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY ALL)
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept FROM sizes JOIN found USING (doc_id)
"""
