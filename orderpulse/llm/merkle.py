"""A Merkle manifest of a dataset, with a proof for every row, by nested-interval labels.

Every row is a leaf; the leaves of a source, in ascending doc_id, make a tree in which every `FAN_OUT` consecutive nodes
have one parent, and the sources' roots make a tree of the same kind. A node is labelled with the interval of leaf ranks
[lo, hi) that it covers, so that no node needs a pointer:

- Ranks are exact and found without gathering a source in a task (see ranks.py).
- A level is built from the one below by grouping intervals into buckets of the level's width.
- Ancestors are attached from the top: a node lies below the node of the next level in whose interval its own lies. Only
  nodes of one bucket are compared, so a join key has at most FAN_OUT rows, whatever the size of a source.
- A node's siblings are what remains of its parent's interval without its own: children that end before it begins come
  left of it, children that begin after it ends right of it.

A run of leaves travels with its ancestors' siblings once; its rows' proofs are made from that in one task.

Every input row gives one output row, repeated rows and null ids included. A null id comes first in its source and is
never tampered with; rows that share an id follow each other by their leaf. A null source is a source of its own. An
empty table gives an empty result. Columns beside the five that are hashed are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderpulse.llm.common import stored
from orderpulse.llm.ranks import ranked

FAN_OUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def field(value: Column) -> Column:
    """A value with its length in front, so that no two rows give the same bytes."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf(**instead: Column) -> Column:
    """The leaf of a row of documents; `instead` names columns that are taken in place of the row's own."""
    return F.sha2(F.concat(*[field(instead.get(c, F.col(c))) for c in FIELDS]), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """(grp, doc_id, leaf, tampered): tampered is the leaf after lower-casing, null where a row is left alone."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    tampered = F.when(chosen, leaf(text=F.translate("text", UPPER, LOWER)))
    grp = F.coalesce(F.concat(F.lit("1"), F.col("source").cast("string")), F.lit("0"))  # the null source comes first
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *FIELDS[1:])
    return docs.select(grp.alias("grp"), "doc_id", leaf().alias("leaf"), tampered.alias("tampered"))


def joined_digests(children: str) -> Column:
    return F.sha2(F.concat_ws("", F.col(f"{children}.digest")), 256)


def tree(rows: DataFrame, order: list[str]) -> list[DataFrame]:
    """The levels of the trees over the rows (grp, digest, ...) of each group, lowest first.

    A node has grp, n (leaves of its group), lo, hi, digest and children, in order; children of the lowest level are the
    rows themselves. A group with one row has one node, whose digest is the row's. A group has no nodes above its root.
    """
    others = [c for c in rows.columns if c not in ("grp", "digest")]
    rows = ranked(rows, order)
    runs = rows.groupBy("grp", F.floor(F.col("rank") / FAN_OUT).alias("bucket")).agg(
        F.first("n").alias("n"), F.min("rank").alias("lo"), (F.max("rank") + 1).alias("hi"),
        F.sort_array(F.collect_list(F.struct("rank", "digest", *others))).alias("children"),
    )
    digest = F.when(F.col("n") == 1, F.col("children")[0]["digest"]).otherwise(joined_digests("children"))
    levels = [stored(runs.select("grp", "n", "lo", "hi", digest.alias("digest"), "children"), "tree")]
    largest = levels[0].agg(F.max("n")).first()[0] or 0
    width = FAN_OUT
    while width < largest:
        width *= FAN_OUT
        upper = levels[-1].filter(F.col("n") > width // FAN_OUT).groupBy("grp", F.floor(F.col("lo") / width).alias("bucket"))
        upper = upper.agg(
            F.first("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
            F.sort_array(F.collect_list(F.struct("lo", "hi", "digest"))).alias("children"),
        )
        levels.append(stored(upper.select("grp", "n", "lo", "hi", joined_digests("children").alias("digest"), "children"), "tree"))
    return levels


def roots(levels: list[DataFrame]) -> DataFrame:
    """(grp, digest) of each group's root."""
    found = [level.filter(F.col("n") <= FAN_OUT ** (k + 1)) for k, level in enumerate(levels)]
    out = found[0].select("grp", "digest")
    for level in found[1:]:
        out = out.union(level.select("grp", "digest"))
    return out


def _digests(children: Column, wanted) -> Column:
    return F.array_join(F.transform(F.filter(children, wanted), lambda c: c["digest"]), "")


def attached(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The nodes of the lowest level with `path`, a (left, right) pair of sibling digests for each level above.

    `tops` has a row for each grp: the path above its root, and columns that all its nodes get."""
    given = [c for c in tops.columns if c not in ("grp", "path")]
    out = None
    for k in range(len(levels) - 1, -1, -1):
        own = levels[k].filter(F.col("n") <= FAN_OUT ** (k + 1)).join(tops, "grp")
        own = own.select("grp", "n", "lo", "hi", "children", "path", *given)
        if out is not None:
            width = FAN_OUT ** (k + 2)
            above = out.select("grp", F.floor(F.col("lo") / width).alias("bucket"), F.struct("lo", "hi", "children").alias("up"),
                               F.col("path").alias("up_path"), *given)
            below = levels[k].withColumn("bucket", F.floor(F.col("lo") / width))
            below = below.join(above, ["grp", "bucket"]).filter("lo >= up.lo AND hi <= up.hi")
            left = _digests(F.col("up.children"), lambda c: c["hi"] <= F.col("lo"))
            right = _digests(F.col("up.children"), lambda c: c["lo"] >= F.col("hi"))
            path = F.concat(F.array(F.struct(left.alias("left"), right.alias("right"))), "up_path").alias("path")
            own = own.union(below.select("grp", "n", "lo", "hi", "children", path, *given))
        out = stored(own, "attached") if k else own
    return out


PATH = "array<struct<left: string, right: string>>"


def manifest(docs: DataFrame) -> DataFrame:
    """Runs of leaves: children (rank, digest, doc_id, tampered), path to the root, subroot and root."""
    rows = leaves(docs).withColumnRenamed("leaf", "digest")
    levels = tree(rows, ["doc_id", "digest"])
    sources = roots(levels).select(F.lit("").alias("grp"), "digest", F.col("grp").alias("source"))
    over = tree(sources, ["source"])
    top = roots(over).select("grp", F.col("digest").alias("root"), F.array().cast(PATH).alias("path"))
    runs = attached(over, top).select("n", "path", "root", "children", F.explode("children").alias("own"))
    left = _digests(F.col("children"), lambda c: c["rank"] < F.col("own.rank"))
    right = _digests(F.col("children"), lambda c: c["rank"] > F.col("own.rank"))
    step = F.concat(F.array(F.struct(left.alias("left"), right.alias("right"))), "path")
    path = F.when(F.col("n") > 1, step).otherwise(F.col("path")).alias("path")
    tops = runs.select(F.col("own.source").alias("grp"), path, F.col("own.digest").alias("subroot"), "root")
    return attached(levels, stored(tops, "tops"))


def hashed(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def folded(digest: str, path: list[tuple[str, str]]) -> str:
    for left, right in path:
        digest = hashed(left + digest + right)
    return digest


def proofs(docs: DataFrame, whole: bool = False) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified and, if wanted, the proof's digests themselves."""
    runs = manifest(docs).select("n", "children", "path", "subroot", "root")
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", *["proof"] * whole]
    kinds = {"doc_id": pa.int64(), "verified": pa.bool_()}
    schema = pa.schema([(c, kinds.get(c, pa.string())) for c in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for n, children, path, subroot, root in zip(*(batch[c].to_pylist() for c in range(5))):
                digests = [c["digest"] for c in children]
                path = [(p["left"], p["right"]) for p in path]
                above, ends = "".join([x for p in path for x in p]), {}
                for i, c in enumerate(children):
                    left, right = "".join(digests[:i]), "".join(digests[i + 1 :])
                    proof = left + right + above
                    start = c["tampered"] or c["digest"]
                    start = hashed(left + start + right) if n > 1 else start
                    if start not in ends:  # rows that are left alone fold to the same node of the run
                        ends[start] = folded(start, path)
                    row = (c["doc_id"], c["digest"], subroot, root, hashed(proof), ends[start], ends[start] == root)
                    out.append((*row, proof) if whole else row)
            for part in range(0, len(out), 10_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, f.type) for x, f in zip(zip(*out[part : part + 10_000]), schema)], schema=schema
                )

    ddl = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return runs.mapInArrow(run, ddl + ", proof string" * whole)


def oracle(levels: int = 5) -> str:
    """The same in SQL, for sources of at most 16 ** levels rows and as many sources."""
    measured = lambda x: f"coalesce(strlen(CAST({x} AS VARCHAR)) || ':' || CAST({x} AS VARCHAR), '-')"
    row = lambda text: "sha256(" + " || ".join(measured(x) for x in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    crc = """xor(4294967295, list_reduce(list_concat([4294967295], flatten([[ord(c), -1, -1, -1, -1, -1, -1, -1, -1]
        FOR c IN string_split(CAST(doc_id AS VARCHAR), '')])), lambda a, x: CASE WHEN x >= 0 THEN xor(a, x)
        ELSE xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END) END))"""
    parts = [
        f"""rows AS (SELECT doc_id, coalesce('1' || source, '0') AS grp, {row('text')} AS leaf,
    CASE WHEN {crc} % 5 = 0 THEN {row(f"translate(text, '{UPPER}', '{LOWER}')")} END AS tampered FROM documents)""",
        "placed AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM rows)",
        "a0 AS (SELECT grp, idx, leaf AS digest, count(*) OVER (PARTITION BY grp) AS n FROM placed)",
    ]

    def level(t: str, k: int) -> None:
        parts.append(
            f"""{t}s{k} AS (SELECT x.grp, x.idx, coalesce(string_agg(y.digest, '' ORDER BY y.idx) FILTER (y.idx < x.idx), '') AS l,
    coalesce(string_agg(y.digest, '' ORDER BY y.idx) FILTER (y.idx > x.idx), '') AS r
    FROM {t}{k} x JOIN {t}{k} y ON x.grp = y.grp AND x.idx // {FAN_OUT} = y.idx // {FAN_OUT} WHERE x.n > 1 GROUP BY ALL)"""
        )
        parts.append(
            f"""{t}{k + 1} AS (SELECT *, count(*) OVER (PARTITION BY grp) AS n FROM (SELECT grp, idx // {FAN_OUT} AS idx,
    sha256(string_agg(digest, '' ORDER BY idx)) AS digest FROM {t}{k} WHERE n > 1 GROUP BY ALL))"""
        )

    for k in range(levels):
        level("a", k)
    union = " UNION ALL ".join(f"SELECT grp, digest FROM a{k} WHERE n = 1" for k in range(levels + 1))
    parts.append(f"sub AS ({union})")
    parts.append("""b0 AS (SELECT 0 AS grp, row_number() OVER (ORDER BY grp) - 1 AS idx, digest, count(*) OVER () AS n, grp AS source
    FROM sub)""")
    for k in range(levels):
        level("b", k)
    parts.append("top AS (" + " UNION ALL ".join(f"SELECT digest AS root FROM b{k} WHERE n = 1" for k in range(levels + 1)) + ")")
    steps = [("a", k, f"p.grp = as{k}.grp AND p.idx // {FAN_OUT**k} = as{k}.idx") for k in range(levels)]
    steps += [("b", k, f"b0.idx // {FAN_OUT**k} = bs{k}.idx") for k in range(levels)]
    joins = "\n    ".join(f"LEFT JOIN {t}s{k} ON {on}" for t, k, on in steps)
    proof = " || ".join(f"coalesce({t}s{k}.l || {t}s{k}.r, '')" for t, k, _ in steps)
    sides = ", ".join(f"{t}s{k}.l AS {t}l{k}, {t}s{k}.r AS {t}r{k}" for t, k, _ in steps)
    parts.append(
        f"""f0 AS (SELECT p.doc_id, p.leaf, sub.digest AS subroot, top.root, sha256({proof}) AS proof_sha256,
    coalesce(p.tampered, p.leaf) AS d, {sides} FROM placed p JOIN sub USING (grp) JOIN b0 ON b0.source = p.grp CROSS JOIN top
    {joins})"""
    )
    for i, (t, k, _) in enumerate(steps):
        one = f"CASE WHEN {t}l{k} IS NULL THEN d ELSE sha256({t}l{k} || d || {t}r{k}) END AS d"
        parts.append(f"f{i + 1} AS (SELECT * REPLACE ({one}) FROM f{i})")
    return (
        "WITH " + ",\n".join(parts) + f"\nSELECT doc_id, leaf, subroot, root, proof_sha256, d AS folded_root, d = root AS verified"
        f" FROM f{len(steps)}"
    )
