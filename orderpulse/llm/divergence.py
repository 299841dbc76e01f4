"""Source divergence audit: which sources of a language use words unlike the others.

Words are kept by iceberg prefix refinement. Terms are taken as bytes that end in a zero byte, so that a term is itself
a prefix, told apart from longer terms that begin with it. At each level the prefixes of so many bytes are counted by
distinct documents of the language, one count for each document however many of its terms begin so. A prefix below the
threshold is discarded: no term that begins with it can reach it. Only terms whose prefix is left are looked at in the
next level, with prefixes twice as long, until no prefix is left that is not a whole term. Whole terms that reach the
threshold are kept, with exact counts.

Prefixes are counted under 64-bit hashes of lang and bytes, combined in each task before they are shuffled. Those that a
level leaves reach the tasks of the next as a bitmap of fixed size, filled by their hashes and built in Spark. Two
prefixes with the same bit let a discarded one through; its extensions are then counted and judged like any other, so
results do not depend on it.

Every kept term then has a share in each (lang, source) group and in the lang. Pairs of sources are compared over
blocks of kept terms, each a matrix of bounded size in a task; the blocks' sums are added. All arithmetic is on integers.

A row is a document, repeated rows and null ids included. Null texts, langs and sources are empty strings, which make
groups of their own. A group without terms has the count 0 for each kept term; a lang without kept terms has the value
0 for each pair. An empty table gives an empty result. Columns other than text, lang and source are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderpulse.llm.common import mix64, pieces, record_batch, stored, text_bytes

LEAST_DOCS = 10
FIRST_BYTES = 5
TOP_TERMS = 10
BITMAP_BITS = 24
BLOCK_CELLS = 1 << 16  # of a block's matrix of terms by sources
PIECE = 8 << 20  # bytes of term lists that are worked on at a time
ROWS = 1 << 16  # handed to Spark at a time
HELD = 1 << 20  # entries that a task holds before it combines them
_TERM = re.compile(rb"[A-Za-z\x80-\xff]+")  # UTF-8 bytes: letters of ASCII, and all beyond


def term_lists(docs: DataFrame) -> DataFrame:
    """(lang, source, grp, terms, counts) for every row: a hash of lang and source, its distinct terms in byte order, each
    ended by a zero byte, as one binary value, and how often it has each, as 4-byte integers."""
    schema = pa.schema(
        [("lang", pa.string()), ("source", pa.string()), ("grp", pa.int64()), ("terms", pa.binary()), ("counts", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                terms, counts = [], []
                for text in text_bytes(part["text"]):
                    found = Counter(_TERM.findall(text.lower()))
                    names = sorted(found)
                    terms.append(b"\0".join([*names, b""]))
                    counts.append(np.fromiter(map(found.__getitem__, names), np.uint32, len(names)).tobytes())
                yield record_batch(schema, [part["lang"], part["source"], part["grp"], terms, counts])

    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = docs.select(empty("lang"), empty("source"), empty("text")).withColumn("grp", F.xxhash64("lang", "source"))
    return rows.mapInArrow(run, "lang string, source string, grp long, terms binary, counts binary")


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a large binary column, and where its values begin and the last one ends."""
    at = np.frombuffer(column.buffers()[1] or bytes(8), np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2] or b"", np.uint8), at


def keys_of(langs: pa.Array, prefixes: pa.Array) -> np.ndarray:
    """A hash of each (lang, prefix), of eight bytes at a time."""
    langs = langs.dictionary_encode()
    seeds = np.array([xxhash.xxh64_intdigest(lang) for lang in langs.dictionary.to_pylist()], np.uint64)
    data, at = bytes_of(prefixes)
    padded = np.r_[data, np.zeros(8, np.uint8)]
    eights = np.lib.stride_tricks.as_strided(padded[:8].view(np.uint64), (len(data) + 1,), (1,), writeable=False)
    left, rest = np.arange(len(prefixes)), np.diff(at)
    out = mix64(seeds[langs.indices.to_numpy()] ^ mix64(rest.astype(np.uint64)))
    start = at[:-1]
    while len(left):
        free = np.uint64(8) * (8 - np.clip(rest, 0, 8)).astype(np.uint64)
        own = np.where(rest > 0, eights[start] << np.minimum(free, 63), 0)
        out[left] = mix64(out[left] * np.uint64(0x9E3779B97F4A7C15) ^ own)
        more = rest > 8
        left, start, rest = left[more], start[more] + 8, rest[more] - 8
    return out.view(np.int64)


def bitmap(keys: DataFrame) -> np.ndarray:
    """The low bits of `key`: 2 MB at every size of the data. Spark joins them by words of 8,192 bits."""
    word_bits = 1 << 13
    bits = keys.select(F.col("key").bitwiseAND(F.lit((1 << BITMAP_BITS) - 1)).alias("bit")).distinct()
    words = bits.groupBy(F.floor(F.col("bit") / word_bits).alias("word")).agg(F.collect_set(F.col("bit") % word_bits).alias("bits"))
    out = np.zeros(1 << BITMAP_BITS, bool)
    for r in words.toLocalIterator():
        out[r["word"] * word_bits + np.array(r["bits"], np.int64)] = True
    return np.packbits(out)


def is_set(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys & ((1 << BITMAP_BITS) - 1)
    return (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)


class _Flat:
    """The terms of some rows side by side, each with its row (`doc`) and its place (`code`) among the distinct (lang, term)."""

    def __init__(self, part: pa.RecordBatch):
        blobs = part["terms"].to_pylist()
        data = b"".join(blobs)
        ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 0) + 1
        offsets = np.r_[0, ends].astype(np.int64)
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        words = words.dictionary_encode()
        langs = part["lang"].dictionary_encode()
        stops = np.searchsorted(ends, np.cumsum([len(b) for b in blobs]), side="right")
        self.doc = np.repeat(np.arange(part.num_rows), np.diff(np.r_[0, stops]))
        many = max(1, len(words.dictionary))
        pair = langs.indices.to_numpy().astype(np.int64)[self.doc] * many + words.indices.to_numpy()
        self.code, pairs = pd.factorize(pair)
        self.terms = words.dictionary.take(pa.array(pairs % many))
        self.langs = langs.dictionary.take(pa.array(pairs // many))
        self.sizes = pc.binary_length(self.terms).to_numpy()

    def keys(self, of: np.ndarray, size: int) -> np.ndarray:
        """Hashes of the first `size` bytes of the distinct terms `of`."""
        terms = pc.binary_slice(self.terms.take(pa.array(of)), 0, size)
        return keys_of(self.langs.take(pa.array(of)), terms)


class _Sums:
    """Sums by a few integer columns, combined whenever many entries are held."""

    def __init__(self, columns: int):
        self.columns, self.held, self.n = columns, [], 0

    def add(self, *values: np.ndarray) -> None:
        self.held.append(values)
        self.n += len(values[0])
        if self.n > HELD and len(self.held) > 1:
            self.held = [self.taken()]
            self.n = len(self.held[0][0])

    def taken(self) -> tuple[np.ndarray, ...]:
        if not self.held:
            return tuple(np.zeros(0, np.int64) for _ in range(self.columns + 1))
        whole = pd.DataFrame({i: np.concatenate(x) for i, x in enumerate(zip(*self.held))})
        whole = whole.groupby(list(range(self.columns)), sort=False, as_index=False).sum()
        return tuple(whole[i].to_numpy() for i in range(self.columns + 1))


def prefix_counts(lists: DataFrame, before: np.ndarray | None, last: int, size: int) -> DataFrame:
    """(key, whole, docs) of the prefixes of `size` bytes of terms not judged yet, whose `last` bytes are set in `before`.

    whole is 1 if the prefix is a term."""
    schema = pa.schema([("key", pa.int64()), ("whole", pa.int64()), ("docs", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums(2)
        for batch in batches:
            for part in pieces(batch, "terms", PIECE):
                flat = _Flat(part)
                left = np.flatnonzero(flat.sizes > last)
                if before is not None:
                    left = left[is_set(before, flat.keys(left, last))]
                prefixes = pc.binary_slice(flat.terms.take(pa.array(left)), 0, size).dictionary_encode()
                langs = flat.langs.take(pa.array(left)).dictionary_encode()
                many = max(1, len(prefixes.dictionary))
                code, names = pd.factorize(langs.indices.to_numpy().astype(np.int64) * many + prefixes.indices.to_numpy())
                of = np.full(len(flat.terms), -1)
                of[left] = code
                codes = of[flat.code]
                rows = np.flatnonzero(codes >= 0)
                codes, docs = codes[rows], flat.doc[rows]
                # A row's terms are in byte order, so those with the same prefix are neighbours and count once.
                new = np.r_[True, (codes[1:] != codes[:-1]) | (docs[1:] != docs[:-1])] if len(rows) else np.zeros(0, bool)
                n = np.bincount(codes[new], minlength=len(names))
                text = prefixes.dictionary.take(pa.array(names % many))
                keys = keys_of(langs.dictionary.take(pa.array(names // many)), text)
                data, at = bytes_of(text)
                sums.add(keys, (data[at[1:] - 1] == 0).astype(np.int64), n)
        yield record_batch(schema, list(sums.taken()))

    found = lists.select("lang", "terms").mapInArrow(run, "key long, whole long, docs long")
    return found.groupBy("key", "whole").agg(F.sum("docs").alias("docs"))


def kept_keys(lists: DataFrame, least: int = LEAST_DOCS) -> tuple[DataFrame, int]:
    """(key) of the terms in at least so many documents of their lang; a size in bytes that none of them exceeds."""
    kept, bits, last, size = None, None, 0, FIRST_BYTES
    while True:
        left = stored(prefix_counts(lists, bits, last, size).filter(F.col("docs") >= least), "prefixes")
        terms = left.filter("whole = 1").select("key")
        kept = terms if kept is None else kept.union(terms)
        unfinished = left.filter("whole = 0")
        if unfinished.isEmpty():
            return kept, size
        bits, last, size = bitmap(unfinished), size, 2 * size


def term_counts(lists: DataFrame, kept: DataFrame, longest: int) -> DataFrame:
    """(lang, source, term, n) with n > 0 for the kept terms."""
    bits = bitmap(kept)
    schema = pa.schema([("key", pa.int64()), ("grp", pa.int64()), ("n", pa.int64()), ("term", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, named = _Sums(2), np.zeros(0, np.int64)
        for batch in batches:
            for part in pieces(batch, "terms", PIECE):
                flat = _Flat(part)
                left = np.flatnonzero(flat.sizes <= longest)
                keys = flat.keys(left, longest)
                held = is_set(bits, keys)
                left, keys = left[held], keys[held]
                of = np.full(len(flat.terms), -1)
                of[left] = np.arange(len(left))
                codes = of[flat.code]
                rows = np.flatnonzero(codes >= 0)
                group, groups = pd.factorize(part["grp"].to_numpy())
                many = max(1, len(left))
                at, pairs = pd.factorize(group[flat.doc[rows]] * many + codes[rows])
                n = np.bincount(at, np.frombuffer(b"".join(part["counts"].to_pylist()), np.uint32)[rows], len(pairs))
                sums.add(keys[pairs % many], groups[pairs // many], n.astype(np.int64))
                new = np.flatnonzero(~np.isin(keys, named))  # a task names a term once
                named = np.union1d(named, keys[new])
                none = [None] * len(new)
                yield record_batch(schema, [keys[new], none, none, flat.terms.take(pa.array(left[new])).cast(pa.binary())])
        key, group, n = sums.taken()
        for a in range(0, len(n), ROWS):
            own = slice(a, a + ROWS)
            yield record_batch(schema, [key[own], group[own], n[own], pa.nulls(len(n[own]), pa.binary())])

    found = stored(lists.select("lang", "grp", "terms", "counts").mapInArrow(run, "key long, grp long, n long, term binary"), "key-counts")
    names = found.filter("term IS NOT NULL").select("key", "term").distinct().join(kept, "key", "left_semi")
    # A task's rows are summed already. Dealt by term, they are summed and named without another shuffle.
    counts = found.filter("n > 0").select("key", "grp", "n").repartition("key").groupBy("key", "grp").agg(F.sum("n").alias("n"))
    groups = lists.select("grp", "lang", "source").distinct()
    return counts.join(names, "key").join(groups, "grp").select("lang", "source", "term", "n")


def share(count: str, whole: str, terms: str):
    """1 + floor(10**9 * (count + 2) / (whole + 2 * terms)), in whole numbers of any size."""
    return F.expr(
        f"1 + (CAST(1000000000 AS DECIMAL(10, 0)) * CAST({count} + 2 AS DECIMAL(20, 0)))"
        f" DIV CAST({whole} + 2 * {terms} AS DECIMAL(20, 0))"
    )


def gap(p, q):
    """floor((p - q)**2 / (p + q)), for whole numbers up to 10**9 + 1."""
    return (p - q) * (p - q) // (p + q)


def pair_sums(counts: DataFrame, groups: DataFrame, sizes: DataFrame) -> DataFrame:
    """(lang, source, item, value) for each two sources of a lang in both orders: gap() summed over all kept terms."""
    width = F.greatest(F.lit(1), F.floor(F.lit(BLOCK_CELLS) / F.col("sources")))
    blocks = F.ceil(F.col("terms") / width).cast("long")
    dealt = counts.join(sizes.filter("terms > 0").select("lang", blocks.alias("blocks")), "lang")
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks")))
    # A group's share of a term that it lacks is needed in every block of its lang, so each block gets all groups' rows.
    absent = groups.join(sizes.filter("terms > 0").select("lang", blocks.alias("blocks")), "lang")
    absent = absent.select("lang", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "source", "base")
    present = dealt.select("lang", "block", "source", "term", "p")

    def compare(key, have: pd.DataFrame, base: pd.DataFrame) -> pd.DataFrame:
        names, start = base["source"].to_numpy(), base["base"].to_numpy()
        at = pd.Series(range(len(names)), index=names)
        row, terms = pd.factorize(have["term"])
        shares = np.repeat(start[:, None], len(terms), axis=1)
        shares[at[have["source"]].to_numpy(), row] = have["p"].to_numpy()
        a, b, value = [], [], []
        for i in range(len(names) - 1):
            sums = gap(shares[i + 1 :], shares[i]).sum(axis=1)
            a += [names[i]] * len(sums)
            b += names[i + 1 :].tolist()
            value += sums.tolist()
        return pd.DataFrame({"lang": key[0], "source": a, "item": b, "value": value}).astype({"value": "int64"})

    sums = present.groupBy("lang", "block").cogroup(absent.groupBy("lang", "block"))
    sums = sums.applyInPandas(compare, "lang string, source string, item string, value long")
    sums = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    return sums.union(sums.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))


def audit(docs: DataFrame, least: int = LEAST_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: part 'pair' ranks the other sources, part 'term' the group's own words."""
    lists = stored(term_lists(docs), "terms")
    kept, longest = kept_keys(lists, least)
    counts = stored(term_counts(lists, kept, longest), "term-counts")
    kept = stored(counts.select("lang", "term").distinct(), "kept-terms")
    every = stored(lists.select("lang", "source").distinct(), "groups")  # sources by langs: far fewer than documents
    sizes = kept.groupBy("lang").agg(F.count("*").alias("terms"))
    sizes = every.groupBy("lang").agg(F.count("*").alias("sources")).join(sizes, "lang", "left").na.fill(0, ["terms"])
    groups = every.join(counts.groupBy("lang", "source").agg(F.sum("n").alias("whole")), ["lang", "source"], "left")
    groups = groups.na.fill(0, ["whole"]).join(sizes.select("lang", "terms"), "lang")
    groups = stored(groups.filter("terms > 0").withColumn("zero", F.lit(0)).withColumn("base", share("zero", "whole", "terms")), "groups")
    shares = counts.join(groups.select("lang", "source", "whole", "terms"), ["lang", "source"])
    shares = stored(shares.select("lang", "source", "term", share("n", "whole", "terms").alias("p")), "shares")

    others = every.select("lang", "source").join(every.select("lang", F.col("source").alias("item")), "lang")
    pairs = others.filter("source <> item").join(pair_sums(shares, groups, sizes), ["lang", "source", "item"], "left")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).cast("long").alias("value"))

    lang = counts.groupBy("lang", "term").agg(F.sum("n").alias("n"))
    whole = counts.groupBy("lang").agg(F.sum("n").alias("whole")).join(sizes.select("lang", "terms"), "lang")
    lang = lang.join(whole, "lang").select("lang", "term", share("n", "whole", "terms").alias("q"))
    ahead = shares.join(lang, ["lang", "term"]).filter("p > q")
    item = F.expr("decode(substr(term, 1, length(term) - 1), 'UTF-8')").alias("item")
    ahead = ahead.select("lang", "source", F.lit("term").alias("part"), item, F.expr("(p - q) * (p - q) DIV (p + q)").alias("value"))

    place = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    number = F.row_number().over(place)
    ahead = ahead.withColumn("rank", number).filter(F.col("rank") <= top)
    return pairs.withColumn("rank", number).union(ahead)


ORACLE = f"""
WITH words AS (
    SELECT rowid AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
    FROM (SELECT *, row_number() OVER () AS rowid FROM documents)),
groups AS (SELECT DISTINCT coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
kept AS (SELECT lang, term FROM words GROUP BY ALL HAVING count(DISTINCT row) >= {LEAST_DOCS}),
terms AS (SELECT lang, count(kept.term) AS v FROM groups LEFT JOIN kept USING (lang) GROUP BY lang, source),
v AS (SELECT DISTINCT * FROM terms),
found AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
filled AS (SELECT g.lang, g.source, k.term, coalesce(f.n, 0) AS n FROM groups g JOIN kept k USING (lang)
    LEFT JOIN found f USING (lang, source, term)),
shares AS (SELECT lang, source, term, n,
    1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY lang, source) + 2 * v) AS p FROM filled JOIN v USING (lang)),
lang_counts AS (SELECT lang, term, sum(n) AS n FROM found GROUP BY ALL),
lang_shares AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY lang) + 2 * v) AS q
    FROM lang_counts JOIN v USING (lang)),
pair_sums AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pair_sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
ahead AS (SELECT lang, source, 'term' AS part, term AS item, CAST((p - q) * (p - q) // (p + q) AS BIGINT) AS value
    FROM shares JOIN lang_shares USING (lang, term) WHERE n > 0 AND p > q)
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM ahead)
QUALIFY part = 'pair' OR rank <= {TOP_TERMS}
"""
