"""Sampled segmentations: exact probabilities, reproducible draws, lossless decoding."""

import math
from collections import Counter

import numpy as np
import public_tokenizers
from llm_data import SF, docs_frame

from orderpulse.llm import sampling
from orderpulse.llm.common import table

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    None, "", " ", "  lead", "trail  ", "Hello  wörld\n x", "▁marker ▁", "漢字 🙂 \x00\x7f", "a" * 3000, "line\r\nline\t\ttab",
    "<s> </s> <unk> <0x41>", " " * 40 + "x", "ñandú " * 200,
]


def all_ways(text, vocabulary):
    """Every segmentation of a text without byte pieces, and its weight."""
    if not text:
        return {(): 1.0}
    out = {}
    for n in range(1, len(text) + 1):
        if text[:n] in vocabulary.weight:
            i, w = vocabulary.weight[text[:n]]
            for rest, p in all_ways(text[n:], vocabulary).items():
                out[(i, *rest)] = math.exp(w) * p
    return out


def test_draws_follow_the_lattice():
    known = sampling.Vocabulary(PATH, 1.0)
    ways = all_ways(b" there", known)
    n = 20_000
    ids, counts = sampling.Sampler(known).sample([b"there"] * n, sampling.mix64(np.arange(n, dtype=np.uint64)))
    drawn = Counter(tuple(x.tolist()) for x in np.split(ids, np.cumsum(counts)[:-1]))
    whole = sum(ways.values())
    assert set(drawn) <= set(ways) and len(ways) > 10
    for way, weight in ways.items():
        p = weight / whole
        assert abs(drawn[way] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-9


def test_words_factorise():
    """Joint draws of two words have the product of their probabilities."""
    known = sampling.Vocabulary(PATH, 1.0)
    ways = all_ways(b" to be", known)
    n = 20_000
    ids, counts = sampling.Sampler(known).sample([b"to be"] * n, sampling.mix64(np.arange(n, dtype=np.uint64)))
    drawn = Counter(tuple(x.tolist()) for x in np.split(ids, np.cumsum(counts)[:-1]))
    whole = sum(ways.values())
    for way, weight in ways.items():
        p = weight / whole
        assert abs(drawn[way] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-9


def test_lossless_and_reproducible(spark):
    docs = docs_frame(spark, TEXTS, extra="ids")
    first = {r.doc_id: r for r in sampling.sample_pieces(docs.repartition(1), PATH).collect()}
    again = {r.doc_id: r for r in sampling.sample_pieces(docs.repartition(5).orderBy("doc_id"), PATH).collect()}
    assert first == again and len(first) == len(TEXTS)
    assert all(r.lossless and r.n_pieces == len(r.ids) for r in first.values())
    back = {r.doc_id: r.text for r in sampling.decoded(sampling.sample_pieces(docs, PATH), PATH).collect()}
    assert back == {i: t or "" for i, t in enumerate(TEXTS)}
    other = {r.doc_id: r.ids for r in sampling.sample_pieces(docs, PATH, seed=1).collect()}
    assert other[12] != first[12].ids


def test_runs_of_texts_change_nothing():
    texts = [(t or "").encode() for t in TEXTS]
    keys = np.arange(len(texts), dtype=np.uint64)
    known = sampling.Vocabulary(PATH, 1.0)
    whole = sampling.Sampler(known).sample(texts, keys)
    forgetful = sampling.Sampler(known, kept_edges=100)
    parts = [forgetful.sample([t], keys[i : i + 1])[0] for i, t in enumerate(texts)]
    assert np.concatenate(parts).tolist() == whole[0].tolist()


def test_given_documents_and_edge_cases(spark):
    docs = table(spark, SF, "documents")
    rows = sampling.sample_pieces(docs, PATH)
    assert rows.count() == docs.count() and rows.filter("NOT lossless").count() == 0
    assert sampling.sample_pieces(docs.limit(0), PATH).count() == 0
    twice = sampling.sample_pieces(docs_frame(spark, ["the same text"] * 4, ids=[None, None, 3, 3]), PATH).collect()
    assert len({(r.doc_id, tuple(r.ids)) for r in twice}) == 2
