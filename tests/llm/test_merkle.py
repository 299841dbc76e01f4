"""The Merkle manifest against a plain version, and its edge cases."""

import hashlib
import zlib

import pytest
from llm_data import SF, docs_frame

from orderpulse.llm import merkle
from orderpulse.llm.common import table


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(leaves):
    """Root, and for each leaf the (left, right) siblings on its way up."""
    paths, level, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for i, k in enumerate(at):
            run = k // 16 * 16
            paths[i].append(("".join(level[run:k]), "".join(level[k + 1 : run + 16])))
        level = [digest(*level[k : k + 16]) for k in range(0, len(level), 16)]
        at = [k // 16 for k in at]
    return level[0], paths


def plain(rows):
    sources, out = {}, []
    for row in rows:
        sources.setdefault(row["source"], []).append((row, leaf(row, row["text"])))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        sources[name].sort(key=lambda x: (x[0]["doc_id"] is not None, x[0]["doc_id"] or 0, x[1]))
        trees[name] = plain_tree([x[1] for x in sources[name]])
    root, tops = plain_tree([trees[name][0] for name in names]) if names else (None, [])
    for name, top in zip(names, tops):
        for (row, own), path in zip(sources[name], trees[name][1]):
            folded, i, text = own, row["doc_id"], row["text"]
            if i is not None and zlib.crc32(str(i).encode()) % 5 == 0 and text is not None:
                folded = leaf(row, "".join(c.lower() if c.isascii() else c for c in text))
            for left, right in path + top:
                folded = digest(left, folded, right)
            proof = digest(*("".join(p) for p in path + top))
            out.append((row["doc_id"], own, trees[name][0], root, proof, folded, folded == root))
    return sorted(out, key=repr)


def result(docs):
    return sorted(map(tuple, merkle.proofs(docs).collect()), key=repr)


def test_given_documents(spark):
    docs = table(spark, SF, "documents")
    assert result(docs) == plain([r.asDict() for r in docs.collect()])


def test_proof_texts_fold_to_the_root(spark):
    docs = table(spark, SF, "documents")
    for row in merkle.proofs(docs, whole=True).collect():
        assert digest(row.proof) == row.proof_sha256 and len(row.proof) % 64 == 0


@pytest.mark.parametrize("n", [1, 2, 16, 17, 33, 257])
def test_sizes_of_one_source(spark, n):
    docs = docs_frame(spark, [f"Text {i}" for i in range(n)]).selectExpr("doc_id", "text", "lang", "'only' AS source", "n_chars")
    assert result(docs) == plain([r.asDict() for r in docs.collect()])


def test_nulls_ties_and_repeated_rows(spark):
    rows = [
        (None, "A text", None, None, None), (None, None, "en", "b", 3), (3, "Same", "en", "b", 4), (3, "Same", "en", "b", 4),
        (3, "Other", None, "b", 5), (-1, "", "en", "", 0), (2**62, "Ünïcode ÀB", "de", "é", 10), (5, "Long " * 300_000, "en", "b", 9),
    ]
    rows += [(i, f"T{i}", "en", f"s{i % 40}", 1) for i in range(100, 300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    clash = docs.selectExpr("*", "'x' AS leaf", "1 AS rank", "2 AS grp", "3 AS digest", "4 AS n")
    assert result(docs) == plain([r.asDict() for r in docs.collect()]) == result(clash)


def test_no_rows(spark):
    assert result(docs_frame(spark, ["x"]).limit(0)) == []


def test_ranks_of_a_hot_group_are_spread(spark):
    from orderpulse.llm.ranks import ranked

    rows = spark.range(30_000).selectExpr("IF(id % 3 < 2, 'hot', CAST(id % 50 AS STRING)) AS grp", "id % 7 AS x", "id")
    out = ranked(rows, ["x"]).collect()
    by = {}
    for r in out:
        by.setdefault(r.grp, []).append((r.rank, r.x, r.n))
    for ranks in by.values():
        ranks.sort()
        assert [r[0] for r in ranks] == list(range(len(ranks))) and [r[1] for r in ranks] == sorted(r[1] for r in ranks)
        assert {r[2] for r in ranks} == {len(ranks)}
