"""Repeated byte strings against brute force over all windows."""

import random
from collections import Counter

import numpy as np
import pytest
from llm_data import SF, docs_frame

from orderpulse.llm import suffixes
from orderpulse.llm.common import table


def plain(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, np.int64)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = 1
        runs = int((np.diff(np.r_[0, gone]) == 1).sum())
        out.append((len(d), int(gone.sum()), runs, bytes(b for b, g in zip(d, gone) if not g)))
    return out


def got(docs, length, **more):
    rows = suffixes.without_repeats(docs, length, **more).collect()
    return sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in rows)


def test_transform_finds_equal_windows():
    rng = random.Random(3)
    contexts = ["".join(rng.choice("ab\0é") for _ in range(rng.randrange(12, 60))).encode() for _ in range(300)]
    owner, place, group = suffixes.repeated_windows(contexts, 12)
    windows = [contexts[o][p : p + 12] for o, p in zip(owner.tolist(), place.tolist())]
    assert len(windows) == sum(len(c) - 11 for c in contexts)
    classes = {}
    for w, g in zip(windows, group.tolist()):
        assert classes.setdefault(w, g) == g
    assert len(set(classes.values())) == len(classes)


def noisy(rng, n):
    """Texts with copies, edited copies, shared passages and periodic stretches."""
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 9))) for _ in range(200)]
    body = lambda k: " ".join(rng.choice(words) for _ in range(k))
    line, texts = body(15), [None, "", "short", "é" * 300, "ab" * 400, "abc" * 200]
    for _ in range(n):
        texts.append(body(rng.randrange(5, 80)))
    for _ in range(n):
        old = rng.choice([t for t in texts if t]).split(" ")
        old[rng.randrange(len(old))] = rng.choice(words)
        texts.append(" ".join(old))
    texts += [body(8) + line + body(rng.randrange(9)) for _ in range(n)] + [texts[9], texts[9], texts[12]]
    return texts


@pytest.mark.parametrize("length, bucket_rows", [(40, 4000), (40, 7), (3, 50)])
def test_against_brute_force(spark, length, bucket_rows):
    texts = noisy(random.Random(length + bucket_rows), 40)
    expected = [(i, *x) for i, x in enumerate(plain(texts, length))]
    assert got(docs_frame(spark, texts, extra="key"), length, bucket_rows=bucket_rows) == expected


def test_edge_cases(spark):
    a, b = "x" * 150 + "y" * 150, "unique " * 5
    docs = docs_frame(spark, [a, a, b, None], ids=[1, 1, 1, 1])
    assert [r[1:3] for r in got(docs, 200)] == [(0, 0), (35, 0), (300, 300), (300, 300)]
    assert got(docs.limit(0), 200) == []


def test_given_documents(spark):
    docs = table(spark, SF, "documents")
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    expected = [(i, *x) for (i, _), x in zip(rows, plain([t for _, t in rows], 200))]
    assert got(docs, 200) == expected and sum(x[2] for x in expected) > 0
