"""Huffman coding and token-id files against the tokenizer itself."""

import heapq
import zlib
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pytest
from llm_data import SF, docs_frame
from pyspark import cloudpickle
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from orderpulse.llm import huffman, token_ids
from orderpulse.llm.common import table

PATH = public_tokenizers.path("byte_bpe_50k.json")


def plain_cost(counts):
    heap = [c for c in counts if c]
    heapq.heapify(heap)
    total = 0
    while len(heap) > 1:
        a = heapq.heappop(heap) + heapq.heappop(heap)
        total += a
        heapq.heappush(heap, a)
    return total


def test_lengths_are_optimal_and_limited():
    rng = np.random.default_rng(2)
    counts = rng.integers(0, 1000, 500)
    lengths = huffman.code_lengths(counts)
    assert (counts * lengths).sum() == plain_cost(counts.tolist())
    steep = np.array([2**i for i in range(40)])
    lengths = huffman.code_lengths(steep, 8)
    assert lengths.max() <= 8 and sum(2.0 ** -x for x in lengths) <= 1
    assert huffman.code_lengths(np.array([0, 5, 0])).tolist() == [0, 1, 0]
    with pytest.raises(ValueError):
        huffman.code_lengths(np.ones(300, int), 8)


@pytest.mark.parametrize("counts", [[], [0], [1], [64], [65, 0, 3], [1000, 1, 0, 127, 128, 129], [20_000]])
def test_round_trip(counts):
    rng = np.random.default_rng(4)
    counts = np.array(counts, np.int64)
    symbols = np.minimum(rng.geometric(0.01, int(counts.sum())), 2000)
    lengths = huffman.code_lengths(np.bincount(symbols, minlength=2001))
    coded = huffman.encode(symbols, counts, huffman.canonical_codes(lengths), lengths)
    assert len(coded[0]) == len(counts)
    assert (huffman.decode(*coded, counts, huffman.decoding_table(lengths)) == symbols).all()
    if counts.tolist() == [20_000]:  # a block alone, from its checkpoint
        at = np.r_[0, np.cumsum(np.frombuffer(coded[1][0], "<u2").astype(int))]
        bits = "".join(f"{b:08b}" for b in coded[0][0])[at[7] : at[8]]
        codes = huffman.canonical_codes(lengths)
        assert bits == "".join(f"{int(codes[s]):0{lengths[s]}b}" for s in symbols[7 * 64 : 8 * 64])


TEXTS = [
    None, "", " ", "   ", "one", " two  three ", "a\nb \n c\n\n  d", "it's we'll I'M", "x<|endoftext|>y z", "tab\there  \t x", "é ü 漢字 🙂",
    "1234 56,78", "end ", "   a", "a \x1c b", "no\x85 break   x", "word " * 5000, "\n \n x \n", "a  b", "a   b", "end, of. this!? ª, ⅷ. x٣; it's, don't: e\u0301, 三.",
]


def expected(texts):
    tokenizer = Tokenizer.from_file(PATH)
    ids = [tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]
    starts = np.r_[0, np.cumsum([len(x) for x in ids])].tolist()
    return [(s, len(x), zlib.crc32(np.array(x, "<u4").tobytes()), x) for s, x in zip(starts, ids)]


def test_words_are_cut_as_the_tokenizer_does():
    got = token_ids.Encoder(PATH).encode([t or "" for t in TEXTS])
    assert [np.frombuffer(x, "<u2").tolist() for x in got] == [x[3] for x in expected(TEXTS)]


@pytest.mark.parametrize("per_file", [1 << 24, 500])
def test_files(spark, tmp_path, per_file):
    ids = [7 * i % 101 for i in range(len(TEXTS))]
    folder = str(tmp_path / "files")
    token_ids.write_ids(docs_frame(spark, TEXTS, ids, extra="ids"), folder, PATH, per_file)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32, r.ids) for r in token_ids.read_ids(spark, folder).collect()}
    order = sorted(range(len(TEXTS)), key=lambda i: ids[i])
    assert got == {ids[i]: e for i, e in zip(order, expected([TEXTS[i] for i in order]))}


def test_given_documents(spark, tmp_path):
    docs = table(spark, SF, "documents")
    rows = docs.orderBy("doc_id").select("doc_id", "text").collect()
    token_ids.write_ids(docs, str(tmp_path / "f"), PATH, 10_000)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_ids.read_ids(spark, str(tmp_path / "f"), False).collect()}
    assert got == {r.doc_id: e[:3] for r, e in zip(rows, expected([r.text for r in rows]))}


def test_empty_table_and_null_ids(spark, tmp_path):
    token_ids.write_ids(docs_frame(spark, ["x"]).limit(0), str(tmp_path / "none"), PATH)
    assert token_ids.read_ids(spark, str(tmp_path / "none")).count() == 0
    docs = docs_frame(spark, ["b c d", "a", "b", "b"], ids=[5, None, 5, 5])
    token_ids.write_ids(docs, str(tmp_path / "some"), PATH)
    got = sorted((r.start, r.doc_id, r.n_tokens) for r in token_ids.read_ids(spark, str(tmp_path / "some")).collect())
    assert got == [(0, None, 2), (2, 5, 2), (4, 5, 2), (6, 5, 4)]


def test_more_files_than_an_expression_could_name(spark, tmp_path):
    """Hundreds of files, of which rows without an id and rows of one id fill several."""
    ids = [None] * 120 + [7] * 120 + list(range(100, 260))
    texts = [f"row {i} of many" + " x" * (i % 5) for i in range(400)]
    docs = docs_frame(spark, texts, ids=ids)
    total = sum(len(Tokenizer.from_file(PATH).encode(t, add_special_tokens=False).ids) + 1 for t in texts)
    token_ids.write_ids(docs, str(tmp_path / "f"), PATH, tokens_per_file=total // 400)
    files = spark.read.parquet(str(tmp_path / "f/documents"))
    parts = {r.doc_id: r.parts for r in files.groupBy("doc_id").agg(F.count_distinct("part").alias("parts")).collect()}
    assert parts[None] > 10 and parts[7] > 10 and files.select("part").distinct().count() > 100
    back = token_ids.read_ids(spark, str(tmp_path / "f"), with_ids=False).orderBy("start").collect()
    assert [r.start for r in back] == np.r_[0, np.cumsum([r.n_tokens for r in back])[:-1]].tolist()
    assert [r.doc_id for r in back] == ids and sum(r.n_tokens for r in back) == total


def test_codes_are_made_once(spark, tmp_path):
    """Finding the ranges of the files reads stored codes; each row is coded by one task only."""
    made, encode = spark.sparkContext.accumulator(0), huffman.encode

    def counting(symbols, counts, *args):
        made.add(len(counts))
        return encode(symbols, counts, *args)

    docs = docs_frame(spark, [f"row {i} of many" for i in range(300)])
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(token_ids, "huffman", SimpleNamespace(**vars(huffman) | {"encode": counting}))
        cloudpickle.register_pickle_by_value(token_ids)
        try:
            token_ids.write_ids(docs, str(tmp_path / "f"), PATH, tokens_per_file=200)
        finally:
            cloudpickle.unregister_pickle_by_value(token_ids)
    assert spark.read.parquet(str(tmp_path / "f/documents")).count() == made.value == 300


def test_words_learnt_before_and_anew():
    """Words with and without marks, in one call or several, also after what was learnt is forgotten."""
    texts = ["the one, the two. one two, one. the", "x one, y", "one.. two,; (one) one's the,", ""] * 3
    known = token_ids.Encoder(PATH)
    alone = [known.encode([t])[0] for t in texts]
    known._forget()
    assert alone == known.encode(texts) == [np.array(x[3], "<u2").tobytes() for x in expected(texts)]
