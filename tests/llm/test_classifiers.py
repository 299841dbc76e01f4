"""Toxicity and quality: held-out accuracy, and defined results for odd inputs."""

import zlib

import numpy as np
import pytest
from llm_data import docs_frame

from orderpulse.llm import quality, toxicity
from orderpulse.llm.common import table

SF = "/root/testdata/sf0.01"


def test_buckets_count_every_n_gram():
    owners, found = toxicity.buckets(["Ab\nc", None, ""])
    text = " ab c "
    assert len(found) == sum(max(0, len(text) - n + 1) for n in toxicity.SIZES)
    again = toxicity.buckets(["ab c"])
    assert sorted(found[owners == 0]) == sorted(again[1])
    owner, feature = toxicity.present(np.zeros(5, np.int64), np.array([7, 7, 7, 7, 9]))
    assert sorted(feature.tolist()) == [7 * 4, 7 * 4 + 1, 7 * 4 + 2, 9 * 4]


def test_held_out_rows(spark):
    docs = docs_frame(spark, ["x"] * 40, ids=[None, *range(39)])
    for r in docs.select("doc_id", toxicity.held_out().alias("h")).collect():
        text = "" if r.doc_id is None else str(r.doc_id)
        assert r.h == (zlib.crc32(text.encode()) % 5 == 0)


@pytest.fixture(scope="module")
def planted(spark):
    """Texts of random words, some of them with one of two insults; every seventh is junk."""
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abdeilnorstu"), 5)) for _ in range(300)]
    texts, toxic, good = [], [], []
    for i in range(900):
        body = list(rng.choice(words, 80))
        if bad := i % 6 == 0:
            body[int(rng.integers(80))] = ("Foulmouth", "nastiness")[i % 2]
        if junk := i % 7 == 0:
            body = [w + "###" for w in body]
        texts.append(" ".join(body))
        toxic.append(int(bad))
        good.append(int(not junk))
    labels = spark.createDataFrame([(i, good[i], toxic[i]) for i in range(900)], "doc_id long, quality int, toxic int")
    return docs_frame(spark, texts, extra="score"), labels


def accuracy(scored, labels, column, verdict):
    rows = scored.join(labels, "doc_id").filter(toxicity.held_out()).select(column, verdict).collect()
    return sum(int(r[0]) == int(r[1]) for r in rows) / len(rows)


def test_toxicity_held_out(planted):
    docs, labels = planted
    model = toxicity.fit(docs, labels)
    scored = toxicity.score(docs, model).selectExpr("doc_id", "score", "score >= 0.5 AS verdict")
    assert accuracy(scored, labels, "toxic", "verdict") > 0.95
    assert scored.filter("score < 0 OR score > 1 OR score IS NULL").count() == 0


def test_quality_held_out(planted):
    docs, labels = planted
    model = quality.fit(docs, labels)
    assert accuracy(quality.score(docs, model), labels, "quality", "kept") > 0.97
    kept = quality.keep_good(docs, model)
    assert kept.schema == docs.schema and 700 < kept.count() < 850


def test_given_tables(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    assert accuracy(quality.score(docs, quality.fit(docs, labels)), labels, "quality", "kept") > 0.95


def test_few_or_no_labels(spark):
    docs = docs_frame(spark, [None, "", "word", "x" * 100_000], ids=[1, 1, None, 4])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(4, 1, 1), (4, None, None), (None, 0, 0), (77, 1, 0)], "doc_id long, quality int, toxic int")
    for labels, empty in ((none, True), (one, False)):
        scores = [r.score for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()]
        assert len(scores) == 4 and all(0 <= s <= 1 for s in scores)
        assert not empty or max(scores) < 0.5
        rows = quality.score(docs, quality.fit(docs, labels)).collect()
        assert len(rows) == 4 and all(r.kept for r in rows)
    assert toxicity.score(docs.limit(0), toxicity.fit(docs.limit(0), none)).count() == 0
    assert quality.score(docs.limit(0), quality.fit(docs.limit(0), none)).count() == 0
