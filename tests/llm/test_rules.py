"""Quality rules: measurements against plain Python, SQL counterpart, policies and ablation."""

import re
from collections import Counter

import compare
from llm_data import SF, docs_frame

from orderpulse.llm import rules
from orderpulse.llm.queries import op6_quality_rules

TEXTS = [
    None, "", " \n\t\x0b", "one", "a b", "a b c", "a b c a b c", "x x x x x x", "# b*c $%&|<> e\n\nf\nf\n f\nf",
    "A B\nA B\nÀ É!! é\x85z w", "word " * 60, " ".join(f"w{i}" for i in range(30_000)), "tic tac toe " * 9000,
]


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_measures(spark):
    docs = docs_frame(spark, TEXTS, extra="n_words")
    got = {r.doc_id: tuple(r)[1:6] for r in rules.ledger(docs).collect()}
    assert got == {i: plain(t) for i, t in enumerate(TEXTS)}
    assert rules.ledger(docs.limit(0)).count() == 0
    repeated = docs_frame(spark, ["a", "a"], ids=[None, None])
    assert [tuple(r)[:2] for r in rules.ledger(repeated).collect()] == [(None, 1), (None, 1)]


def test_matches_sql(spark):
    assert compare.assert_same(op6_quality_rules(spark, SF), rules.ORACLE, SF)


def test_policies_and_ablation(spark):
    rows = rules.ledger(docs_frame(spark, TEXTS)).cache()
    bits = [r.failed_bits for r in rows.collect()]
    for policy in rules.POLICIES:
        used = rules.mask(policy)
        kept = [r.kept for r in rules.apply_policy(rows, policy).collect()]
        assert kept == [b & used == 0 for b in bits]
        for r in rules.ablation(rows, policy).collect():
            bit = rules.BIT[r.rule]
            assert r.fails == sum(b & bit != 0 for b in bits)
            assert r.fails_alone == sum(b & used == bit for b in bits)
            assert r.kept_without == sum(b & used & ~bit == 0 for b in bits)
    rows.unpersist()


def test_plan_is_native(spark):
    plan = op6_quality_rules(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
