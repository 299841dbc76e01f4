"""The pipeline, stage by stage, against plain versions, and its edge cases."""

import re

import corpus_pipeline
import numpy as np
import pytest
from llm_data import SF, docs_frame
from test_decontaminate import plain as plain_matches
from test_minhash import plain_kept

from orderpulse.llm import secrets
from orderpulse.llm.common import stored, table


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def test_stages_on_given_documents(spark):
    docs = table(spark, SF, "documents")
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    texts = lambda frame: {r.doc_id: r.text for r in frame.collect()}

    good = stored(stage("quality")(spark, docs, SF), "test")
    kept = texts(good)
    agree = [bool(q) == (i in kept) for i, q in labels.items()]
    assert sum(agree) > 0.9 * len(agree) and good.schema == docs.schema

    single = stored(stage("near_dedup")(spark, good, SF), "test")
    assert texts(single) == {i: kept[i] for i in plain_kept(kept.items())} and single.schema == docs.schema

    clean = stored(stage("decontaminate")(spark, single, SF), "test")
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    leaks = {i for i, _ in plain_matches(texts(single).items(), items)}
    assert texts(clean) == {i: t for i, t in texts(single).items() if i not in leaks}

    masked = stored(stage("secrets")(spark, clean, SF), "test")
    expected = {i: secrets.redact(t, secrets.find(t)[1]) for i, t in texts(clean).items()}
    assert texts(masked) == expected and masked.schema == docs.schema
    assert not any(re.search("[0-9a-f]{16}", t) for t in expected.values())

    last = stage("pieces")(spark, masked, SF)
    assert last.count() == masked.count() and last.filter("NOT lossless").count() == 0


def test_run_matches_its_stages(spark):
    whole = corpus_pipeline.run(spark, SF)
    assert whole.columns == ["doc_id", "n_pieces", "ids", "lossless"] and 0 < whole.count() < 250


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_edge_cases(spark, name):
    rng = np.random.default_rng(8)
    texts = [None, "", "same words in two rows", "same words in two rows", " ".join(map(str, rng.integers(0, 999, 40_000))), "x"]
    docs = docs_frame(spark, texts, ids=[None, 5, 6, 6, None, 9], extra="score")
    out = stage(name)(spark, docs, SF).collect()
    if name == "near_dedup":
        assert sorted((r.doc_id or -1, (r.text or "")[:4]) for r in out) == sorted(
            [(5, ""), (6, "same"), (-1, texts[4][:4]), (9, "x")]
        )
    elif name == "pieces":
        assert len(out) == 6
    elif name != "quality":
        assert len(out) == 6 and all(r.score == "clash" for r in out)
    assert stage(name)(spark, docs.limit(0), SF).count() == 0
