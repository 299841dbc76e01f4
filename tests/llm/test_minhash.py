"""MinHash near-duplicates against brute force over all pairs, and the pipeline's stage built on them."""

import random

import corpus_pipeline
import numpy as np
import pytest
from llm_data import SF, docs_frame

from orderpulse.llm import minhash
from orderpulse.llm.common import Scratch, stored, table
from orderpulse.llm.stars import components


def word_sets(rows):
    sets = {}
    for i, text in rows:
        words = (text or "").encode().lower().split()
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    return sets


def plain(rows, percent=85, link_empty=False):
    """(size, least id of the component) of each id."""
    sets = word_sets(rows)
    ids, label = sorted(sets), {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            shared = len(sets[a] & sets[b])
            if 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared) and (sets[a] or sets[b] or link_empty):
                x, y = root(a), root(b)
                label[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def plain_kept(rows):
    """The ids that the pipeline's stage keeps: the smallest of each component at five words and 0.8."""
    return {i for i, (_, root) in plain(rows, 80, link_empty=True).items() if i == root}


def result(docs, **settings):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs, **settings).collect()}


def stage(docs):
    return dict(corpus_pipeline.STAGES)["near_dedup"](docs.sparkSession, docs, SF)


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def around_the_threshold(seed):
    rng, texts = random.Random(seed), []
    passage = " ".join(f"common{i}" for i in range(40))
    for k in range(6):
        words = [f"w{k}x{i}" for i in range(rng.randrange(5, 220))]
        texts += [edited(rng, words, rng.randrange(6)) for _ in range(12)]
    texts += [f"{passage} " + " ".join(f"own{k}n{i}" for i in range(rng.randrange(4, 60))) for k in range(60)]
    rng.shuffle(texts)
    return texts


def test_given_documents(spark):
    docs = table(spark, SF, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert result(docs) == plain(rows)
    out = stage(docs)
    kept = plain_kept(rows)
    assert out.schema == docs.schema and {r.doc_id: r.text for r in out.collect()} == {i: t for i, t in rows if i in kept}


def test_edited_copies_around_the_threshold(spark):
    texts = around_the_threshold(3)
    assert result(docs_frame(spark, texts)) == plain(list(enumerate(texts)))
    assert {r.doc_id for r in stage(docs_frame(spark, texts)).collect()} == plain_kept(list(enumerate(texts)))


def test_the_exact_rest_finds_every_link_of_coarse_buckets(spark, monkeypatch):
    monkeypatch.setattr(minhash, "PARTNERS", 3)
    texts = around_the_threshold(4)
    assert result(docs_frame(spark, texts), bands=60, rows=2) == plain(list(enumerate(texts)))


def test_pairs_of_template_pages_stay_few(spark, monkeypatch):
    """Pages that share a template but are not linked are not compared in pairs."""
    rng, stores, store = random.Random(5), {}, Scratch.store

    def counting(self, frame, purpose, *args):
        out = store(self, frame, purpose, *args)
        stores[purpose] = max(stores.get(purpose, 0), out.count())
        return out

    monkeypatch.setattr(Scratch, "store", counting)
    template = " ".join(f"common{i}" for i in range(200))
    texts = [template + " " + " ".join(f"own{k}n{i}" for i in range(rng.randrange(28, 40))) for k in range(1_500)]
    kept = stage(docs_frame(spark, texts))
    assert kept.count() == 1_500
    assert stores["pairs"] < 30 * 1_500 and stores["met"] < 1_500 and stores["links"] == 0


def test_short_empty_and_repeated_texts(spark):
    texts = ["a b c", "A  b\tC", "a b", "", None, " ", "a b c d e", "a b c d e f", "a b c d e f g h", "x", "\x0b", "x"]
    rows = list(enumerate(texts))
    assert result(docs_frame(spark, texts)) == plain(rows)
    assert {r.doc_id for r in minhash.keep_one(docs_frame(spark, texts)).collect()} == plain_kept(rows)


def test_null_ids_and_clashing_columns(spark):
    texts = ["one two three four five six", "one two three four five six", "long " + "word " * 200_000, None, "", "alone", "alone"]
    docs = docs_frame(spark, texts, ids=[None, 4, None, None, 7, None, -1], extra="fp").withColumnRenamed("source", "label")
    found = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs).collect()), key=repr)
    assert found == sorted(
        [(None, 2, 4), (4, 2, 4), (None, 2, None), (None, 0, None), (7, 0, 7), (None, 1, -1), (-1, 1, -1)], key=repr
    )
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, (r.text or "")[:5]) for r in kept.filter("doc_id IS NOT NULL").collect()) == [(-1, "alone"), (4, "one t"), (7, "")]
    assert [r.text[:5] for r in kept.filter("doc_id IS NULL").collect()] == ["long "]


def test_no_rows(spark):
    empty = docs_frame(spark, ["x"]).limit(0)
    assert result(empty) == {} and stage(empty).count() == 0


def test_minima_are_those_of_each_set(monkeypatch):
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 2**63, n).astype(np.uint64)) for n in (0, 1, 5, 300, 0, 77, 1000)]
    whole = minhash.minima(sets, 16)
    monkeypatch.setattr(minhash, "CHUNK", 64)
    assert (minhash.minima(sets, 16) == whole).all()
    for s, row in zip(sets, whole):
        assert (minhash.minima([s], 16)[0] == row).all()


def test_stars_on_chains_and_hubs(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(6, 90)] + [(7, 7)]
    edges += [(rng.randrange(1000, 1400), rng.randrange(1000, 1400)) for _ in range(250)]
    rng.shuffle(edges)
    label = {x: x for e in edges for x in e}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a, b in edges:
        x, y = root(a), root(b)
        label[max(x, y)] = min(x, y)
    expected = {(i, root(i)) for i in label if root(i) != i}
    frame = stored(spark.createDataFrame(edges, "a long, b long"), "test")
    assert {tuple(r) for r in components(frame, Scratch(spark)).collect()} == expected
    none = spark.createDataFrame([], "a long, b long")
    assert components(none, Scratch(spark)).count() == 0


def test_simhash_finds_links_of_its_own(spark, monkeypatch):
    """The stage's candidates come from SimHash first: with bands that find nothing, close copies are linked all the same."""
    rng, texts = random.Random(4), []
    for k in range(6):
        words = [f"w{k}x{i}" for i in range(3000)]
        texts += [" ".join(words), edited(rng, words, 1), edited(rng, words, 1)]
    docs = docs_frame(spark, texts)
    apart = dict(percent=80, bands=1, rows=4000)
    assert len({c for _, c in result(docs, **apart).values()}) == len(texts)
    assert len({c for _, c in result(docs, radius=3, **apart).values()}) < len(texts) - 6
    used, search = [], minhash.similar_fingerprints
    monkeypatch.setattr(minhash, "similar_fingerprints", lambda fps, radius: used.append(radius) or search(fps, radius))
    assert stage(docs).count() == 6 and used == [3]


def test_candidates_of_simhash_and_minhash_are_confirmed_together(spark, monkeypatch):
    """One round of confirmation and components for both; another only for what the exact rest still links."""
    rng, words, runs = random.Random(9), [f"w{i}" for i in range(400)], []
    texts = [" ".join(words), edited(rng, words, 1), edited(rng, words, 2), "apart " * 3]
    for name in ("confirmed", "components"):
        call = getattr(minhash, name)
        monkeypatch.setattr(minhash, name, lambda *a, call=call, name=name: runs.append(name) or call(*a))
    assert {r.doc_id for r in stage(docs_frame(spark, texts)).collect()} == plain_kept(list(enumerate(texts)))
    assert runs == ["confirmed", "components"]
