"""Token-ID output: texts as Huffman-coded ids in files, and back.

write_ids() tokenizes every whole text, counts all ids, and writes a folder with two Parquet tables: `codebook` (symbol,
length of its canonical code) and `documents`, one folder part=N per range of rows, in ascending order, each sorted by
doc_id, with each document's ids as a payload of codes and its checkpoints (see huffman.py). Ranges are found by Spark
from a sample of the rows and may cut through the rows of one doc_id, so that neither a hot id nor rows without an id
fill one file. Any document, and any block of 64 ids
in it, can be decoded by itself. read_ids() decodes them and tells each document's place in the whole sequence.

Null texts are empty; each document ends with the end id. Null doc_ids come first, documents with the same doc_id
follow each other, shorter ones first. An empty table gives empty files.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderpulse.llm import huffman
from orderpulse.llm.common import Scratch, id_and_text, pieces, record_batch

END_ID = 2
CACHED = 600_000
IDS = 1 << 20  # bytes of ids that are coded at a time, few enough for the processor's cache
TOKENS_PER_FILE = 16 << 20
# A space that is alone between two words is always the start of the next token, so texts can be cut there.
_UNEVEN = " [ \n\t\r]|[\n\t\r] |[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_MARKS = ".,!?;:"


def _listed(column: pa.Array) -> list:
    return column.to_numpy(zero_copy_only=False).tolist()


class Encoder:
    """Ids of whole texts; the ids of words met before are remembered."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self._forget()
        pieces_by_id = sorted(self.tokenizer.get_vocab().items(), key=lambda x: x[1])
        self.after_space = np.zeros(pieces_by_id[-1][1] + 1, bool)
        for piece, i in pieces_by_id:
            self.after_space[i] = piece[0] == "\u0120"  # the byte-level name of a space

    def _forget(self) -> None:
        self.parts: dict[str, bytes] = {}  # ids of words after a space, or of their letters
        self.marks: dict[str, bytes] = {"": b""}  # ids of the marks that follow the letters, in order of `places`
        self.places = {"": 0}

    def _ids(self, texts: list[str]) -> list[bytes]:
        done = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, self.kind).tobytes() for x in done]

    def _words(self, words: pa.Array) -> pa.Array:
        """Ids of words that follow a space. Letters and the marks after them are separate to the tokenizer."""
        letters = pa.compute.utf8_rtrim(words, characters=_MARKS)
        marked = np.flatnonzero(pa.compute.not_equal(letters, words).to_numpy(zero_copy_only=False))
        split, mark = np.zeros(len(words), bool), np.zeros(len(words), np.int64)
        for k, w, c in zip(marked.tolist(), _listed(words.take(pa.array(marked))), _listed(letters.take(pa.array(marked)))):
            if c.isalpha():
                split[k], mark[k] = True, self._mark(w[len(c) :])
        parts = pa.compute.if_else(pa.array(split), letters, words).dictionary_encode()
        names = _listed(parts.dictionary)
        ids = list(map(self.parts.get, names))
        new = [k for k, x in enumerate(ids) if x is None]
        for k, x in zip(new, self._learn([names[k] for k in new])):
            ids[k] = x
        found = pa.array(ids, pa.large_binary()).take(parts.indices)
        marks = pa.array(list(self.marks.values()), pa.large_binary()).take(pa.array(mark))
        return pa.compute.binary_join_element_wise(found, marks, pa.scalar(b"", pa.large_binary()))

    def _mark(self, marks: str) -> int:
        """The place of the marks among those met before."""
        place = self.places.get(marks)
        if place is None:
            place = self.places[marks] = len(self.places)
            self.marks[marks] = self._ids([marks])[0]
        return place

    def _learn(self, words: list[str]) -> list[bytes]:
        """Ids of words that follow a space, all in one text: a word starts where an id starts with a space."""
        if not words:
            return []
        ids = np.array(self.tokenizer.encode_batch_fast([" " + " ".join(words)], add_special_tokens=False)[0].ids, self.kind)
        starts = np.flatnonzero(self.after_space[ids]).tolist()
        if len(starts) != len(words):
            raise ValueError("the tokenizer does not cut texts at single spaces")
        data, width = ids.tobytes(), self.kind.itemsize
        cuts = [width * a for a in [*starts, len(ids)]]
        found = [data[a:b] for a, b in zip(cuts, cuts[1:])]
        self.parts.update(zip(words, found))
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian ids, each text followed by the end id."""
        if len(self.parts) + len(self.marks) > CACHED:
            self._forget()
        # The first word follows no space; a text with other white space next to a space is encoded as a whole.
        whole = pa.array(texts, pa.large_string())
        uneven = pa.compute.match_substring_regex(whole, _UNEVEN)
        cut = pa.compute.split_pattern(pa.compute.if_else(uneven, "", whole), " ")
        words, ends = cut.values.dictionary_encode(), cut.offsets.to_numpy()
        firsts = _listed(cut.values.take(pa.array(ends[:-1])))
        first = self._ids([t if u else f for f, t, u in zip(firsts, texts, uneven.to_pylist())])
        codes = words.indices.to_numpy().astype(np.int64)
        own = np.ones(len(codes), bool)
        own[ends[:-1]] = False
        used = np.flatnonzero(np.bincount(codes[own], minlength=len(words.dictionary)))
        place = np.zeros(len(words.dictionary), np.int64)
        place[used] = np.arange(len(used))
        codes = place[codes[own]]
        known = self._words(words.dictionary.take(pa.array(used)))
        last = pa.array([*first, np.array([END_ID], self.kind).tobytes()], pa.large_binary())
        # A row of entries for each text: its first word, the others, and the end id. Arrow puts their bytes side by side.
        entries = pa.concat_arrays([known, last])
        starts = np.arange(len(texts)) + ends[:-1]
        row = np.empty(len(own) + len(texts), np.int64)
        place = np.zeros(len(row), bool)
        place[starts] = place[ends[1:] + np.arange(len(texts))] = True
        row[~place] = codes
        row[starts] = len(used) + np.arange(len(texts))
        row[ends[1:] + np.arange(len(texts))] = len(used) + len(texts)
        found = entries.take(pa.array(row))
        data, at = found.buffers()[2], np.frombuffer(found.buffers()[1], np.int64)[: len(row) + 1]
        data = memoryview(data) if data else b""
        return [bytes(data[x:y]) for x, y in zip(at[starts].tolist(), at[np.r_[starts[1:], len(row)]].tolist())]


@lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def tokenized(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids) with ids as little-endian integers."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                ids = encoder(path).encode([t or "" for t in part["text"].to_pylist()])
                width = encoder(path).kind.itemsize
                yield record_batch(schema, [part["doc_id"], [len(x) // width for x in ids], ids])

    return id_and_text(docs).mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def id_counts(rows: DataFrame, path: str) -> DataFrame:
    """(symbol, n) over all ids of all documents."""
    schema = pa.schema([("symbol", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(encoder(path).tokenizer.get_vocab_size(), np.int64)
        for batch in batches:
            for part in pieces(batch, "ids"):
                ids = np.frombuffer(b"".join(part["ids"].to_pylist()), encoder(path).kind)
                total += np.bincount(ids, minlength=len(total))
        held = np.flatnonzero(total)
        yield record_batch(schema, [held, total[held]])

    return rows.select("ids").mapInArrow(run, "symbol long, n long").groupBy("symbol").agg(F.sum("n").alias("n"))


def _dense(codebook: list, column: str) -> np.ndarray:
    out = np.zeros(max((r["symbol"] for r in codebook), default=0) + 1, np.int64)
    for r in codebook:
        out[r["symbol"]] = r[column]
    return out


def encoded(rows: DataFrame, lengths: np.ndarray, path: str) -> DataFrame:
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("payload", pa.binary()), ("checkpoints", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = huffman.canonical_codes(lengths)
        for batch in batches:
            for part in pieces(batch, "ids", IDS):
                ids = np.frombuffer(b"".join(part["ids"].to_pylist()), encoder(path).kind).astype(np.int64)
                counts = part["n_tokens"].to_numpy()
                yield record_batch(schema, [part["doc_id"], counts, *huffman.encode(ids, counts, codes, lengths)])

    return rows.mapInArrow(run, "doc_id long, n_tokens long, payload binary, checkpoints binary")


def _numbered(rows: DataFrame) -> DataFrame:
    """Sorted rows with the number of their task, which names their file, and the number of ids before them in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            counts = batch["n_tokens"].to_numpy()
            starts = before + np.cumsum(counts) - counts
            before += int(counts.sum())
            batch = batch.append_column("part", pa.array(np.full(len(counts), part), pa.int32()))
            yield batch.append_column("before", pa.array(starts, pa.int64()))

    ddl = "doc_id long, n_tokens long, payload binary, checkpoints binary, part int, before long"
    return rows.mapInArrow(run, ddl)


def write_ids(docs: DataFrame, folder: str, path: str, tokens_per_file: int = TOKENS_PER_FILE) -> None:
    """Write the files described above into a new folder. `path` is the tokenizer's file, known to every executor."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    rows = scratch.store(tokenized(docs, path), "ids", "zstd")
    counts = id_counts(rows, path).collect()  # at most one row per id of the vocabulary
    lengths = huffman.code_lengths(_dense(counts, "n"))
    book = [(int(s), int(lengths[s])) for s in np.flatnonzero(lengths)]
    spark.createDataFrame(book, "symbol long, length int").coalesce(1).write.parquet(f"{folder}/codebook")
    parts = -(-sum(r["n"] for r in counts) // tokens_per_file)
    order = ["doc_id", "n_tokens", F.xxhash64("payload"), "payload"]
    # Spark reads what it deals out by ranges twice, the first time for a sample; codes are made once.
    coded = scratch.store(encoded(rows, lengths, path), "payloads")
    scratch.free(rows)
    out = coded.repartitionByRange(max(1, parts), *order[:3]).sortWithinPartitions(*order)
    _numbered(out).write.partitionBy("part").option("compression", "zstd").parquet(f"{folder}/documents")
    scratch.free(coded)


def read_ids(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and, if wanted, ids, decoded from the files."""
    lengths = _dense(spark.read.parquet(f"{folder}/codebook").collect(), "length")
    kinds = "doc_id long, n_tokens long, payload binary, checkpoints binary, before long, part int"
    rows = spark.read.schema(kinds).parquet(f"{folder}/documents")
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()  # a row per file folder
    begin, offsets = 0, {}
    for r in totals:
        offsets[r["part"]] = begin
        begin += r["n"]
    names = ["doc_id", "start", "n_tokens", "ids_crc32", *["ids"] * with_ids]
    schema = pa.schema([(c, pa.list_(pa.int64()) if c == "ids" else pa.int64()) for c in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = huffman.decoding_table(lengths)
        for batch in batches:
            for part in pieces(batch, "payload"):
                counts = part["n_tokens"].to_numpy()
                ids = huffman.decode(part["payload"].to_pylist(), part["checkpoints"].to_pylist(), counts, table)
                data, ends = ids.astype("<u4").tobytes(), np.cumsum(counts)
                sums = [zlib.crc32(data[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), counts.tolist())]
                start = [b + offsets[p] for b, p in zip(part["before"].to_pylist(), part["part"].to_pylist())]
                columns = [part["doc_id"], start, counts, sums]
                if with_ids:
                    columns.append(np.split(ids, ends[:-1]) if len(ends) else [])
                yield record_batch(schema, columns)

    ddl = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    return rows.mapInArrow(run, ddl)
