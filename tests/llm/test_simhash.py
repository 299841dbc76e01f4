"""SimHash against brute force over all pairs."""

import random
import tracemalloc

import numpy as np
import xxhash
from llm_data import SF, docs_frame

from orderpulse.llm import simhash
from orderpulse.llm.common import table


def plain_fingerprint(text, words=3):
    import re

    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not found:
        return 0
    shingles = [" ".join(found[i : i + words]) for i in range(max(1, len(found) - words + 1))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, radius=3):
    """{fingerprint: smallest fingerprint reachable}"""
    nodes = sorted(set(fps))
    label = {f: f for f in nodes}
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(nodes):
            for b in nodes[i + 1 :]:
                if (a ^ b).bit_count() <= radius and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return label


def check(result, rows):
    fps = {i: plain_fingerprint(t) for i, t in rows}
    label = plain_components(fps.values())
    smallest = {}
    for i, f in fps.items():
        smallest[label[f]] = min(i, smallest.get(label[f], i))
    got = {r.doc_id: (r.fp & (2**64 - 1), r.component_id) for r in result.collect()}
    assert got == {i: (f, smallest[label[f]]) for i, f in fps.items()}


def test_given_documents(spark):
    docs = table(spark, SF, "documents")
    check(simhash.near_duplicates(docs), [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_edge_cases(spark):
    base = " ".join(f"word{i}" for i in range(400))
    texts = [None, "", " \n\t", "One", "one", "one two", "A b C", "É à", "x\x85y z", base, base.upper(), base + " tail", base + " other"]
    check(simhash.near_duplicates(docs_frame(spark, texts, extra="fp")), list(enumerate(texts)))
    assert simhash.near_duplicates(docs_frame(spark, texts).limit(0)).count() == 0
    repeated = simhash.near_duplicates(docs_frame(spark, ["a b c", "a b c", "q"], ids=[None, 7, None])).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in repeated) == [(0, 0), (0, 7), (7, 7)]


def clouds(rng, n):
    """Fingerprints around few centres, so that keys hold many of them."""
    centres = [rng.getrandbits(64) for _ in range(4)]
    out = set()
    while len(out) < n:
        f = rng.choice(centres)
        for _ in range(rng.randrange(7)):
            f ^= 1 << rng.randrange(64)
        out.add(f)
    return sorted(out)


def signed(f):
    return f - (1 << 64) if f >> 63 else f


def components_of(edges, nodes):
    label = {f: f for f in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            if label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
    return label


def test_links_of_dense_groups(spark):
    rng = random.Random(5)
    for radius in (0, 1, 2, 3):
        fps = clouds(rng, 500)
        frame = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
        for task_rows in (50_000, 60):
            edges = simhash.similar_fingerprints(frame, radius, task_rows).collect()
            edges = [(r.a & (2**64 - 1), r.b & (2**64 - 1)) for r in edges]
            assert components_of(edges, fps) == plain_components(fps, radius)


def test_large_group_matches_all_pairs():
    rng = random.Random(6)
    fps = np.array(clouds(rng, 300), np.uint64)
    a, b = simhash.links_in_large_group(fps, 3)
    assert components_of(list(zip(a.tolist(), b.tolist())), fps.tolist()) == plain_components(fps.tolist())


def test_bits_of_many_hashes_take_bounded_memory():
    rng = np.random.default_rng(6)
    counts = np.array([3, 0, 200_000, 1, 50_000, 0, 16_384])
    hashes = rng.integers(0, 2**63, counts.sum()).astype(np.uint64) * np.uint64(3)
    tracemalloc.start()
    found = simhash.majority_bits(hashes, counts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16 << 20
    ends = np.cumsum(counts)
    for n, end, bits in zip(counts.tolist(), ends.tolist(), found.tolist()):
        own = hashes[end - n : end]
        assert bits == sum(1 << k for k in range(64) if 2 * int((own >> np.uint64(k) & np.uint64(1)).sum()) > n)
