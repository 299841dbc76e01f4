"""Decontamination against brute force over all windows."""

from collections import Counter

from llm_data import SF, docs_frame

from orderpulse.llm import decontaminate
from orderpulse.llm.common import table


def plain_shingles(words, size=5):
    return Counter(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def plain(texts, items):
    """Documents and items that share a window of at least 0.8."""
    out = set()
    for i, text in texts:
        words = (text or "").lower().split()
        for item, query in items:
            wanted = (query or "").lower().split()
            n, grams = len(wanted), plain_shingles(wanted)
            for at in range(len(words) - n + 1) if n else ():
                own = plain_shingles(words[at : at + n])
                if sum((own & grams).values()) >= 0.8 * sum((own | grams).values()):
                    out.add((i, item))
                    break
    return out


def test_given_documents(spark):
    docs, items = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    texts = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    queries = [(r.item_id, r.text) for r in items.collect()]
    expected = plain(texts, queries)
    found = decontaminate.matches(docs, items)
    assert expected and {(r.doc_id, r.item_id) for r in found.collect()} == expected
    in_blocks = decontaminate.matches(docs, items, item_block=3)
    assert sorted(map(tuple, in_blocks.collect())) == sorted(map(tuple, found.collect()))
    left = {r.doc_id for r in decontaminate.without_matches(docs, items).collect()}
    assert left == {i for i, _ in texts} - {i for i, _ in expected}


LONG = " ".join(f"q{i}" for i in range(60))


def test_edited_windows_and_edge_cases(spark):
    words = LONG.split()
    edited = " ".join([*words[:3], "other", *words[4:]])
    texts = [
        None, "", "unrelated words only", f"before {LONG.upper()} after", f"x {edited} y", f"{LONG} and {LONG}",
        " ".join(words[:30]), "tiny item", "a tiny\titem here", "pad " * 5000 + LONG,
    ]
    items = spark.createDataFrame(
        [(1, LONG), (2, "tiny item"), (3, None), (4, " "), (None, LONG), (1, LONG)], "item_id long, text string"
    )
    rows = decontaminate.matches(docs_frame(spark, texts, extra="item_id"), items).collect()
    got = Counter((r.doc_id, r.item_id) for r in rows)
    long = {3: 1, 4: 1, 5: 2, 9: 1}
    assert got == Counter({(d, i): n for d, n in long.items() for i in (1, None)} | {(7, 2): 1, (8, 2): 1})
    assert {(r.start_word, r.similarity) for r in rows if r.doc_id == 5} == {(0, 1.0), (61, 1.0)}
    assert decontaminate.matches(docs_frame(spark, texts), items.limit(0)).count() == 0
    assert decontaminate.without_matches(docs_frame(spark, texts).limit(0), items).count() == 0


def test_blocks_find_all_fingerprints_within_the_radius():
    import numpy as np

    rng = np.random.default_rng(1)
    items = [(i, " ".join(rng.choice(list("abcdefgh"), 12))) for i in range(150)]
    index = decontaminate.Index(items, 5, 20)
    fps = np.array([x[3] for x in index.items]) ^ rng.integers(0, 1 << 40, 150).astype(np.uint64)
    expected = {(w, i) for w, f in enumerate(fps.tolist()) for i, x in enumerate(index.items) if (f ^ int(x[3])).bit_count() <= 20}
    assert {(w, i) for w, i, _ in index.candidates(12, fps)} == expected


def test_texts_shorter_than_an_item(spark):
    words = LONG.split()
    texts = [" ".join(words[:55]), " ".join(words[4:]).upper(), " ".join(words[:30]), "q0 q1", " ".join(words[:48])]
    items = spark.createDataFrame([(1, LONG)], "item_id long, text string")
    rows = decontaminate.matches(docs_frame(spark, texts), items).collect()
    assert sorted((r.doc_id, r.start_word, r.n_words, r.similarity) for r in rows) == [(0, 0, 55, 51 / 56), (1, 0, 56, 52 / 56)]
    left = decontaminate.without_matches(docs_frame(spark, texts), items).collect()
    assert {r.doc_id for r in left} == {2, 3, 4}
