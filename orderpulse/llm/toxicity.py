"""Toxicity: a character n-gram linear classifier over naive Bayes log-count ratios.

A text's features say which character n-grams occur in it at least once, twice, four and eight times; n-grams are
hashed into a fixed number of buckets. From the labelled
rows, each feature's log-count ratio r = ln((p / |p|) / (q / |q|)) is counted (p: toxic texts that hold it, q: the
others, both smoothed). The features whose ratio is most certain are kept, and a logistic regression is fitted on
features scaled by their ratio. Its score is a probability.

`max_rows` bounds the labelled rows that the fit uses (all rows, if there are fewer; else those of least hash).
Scores read whole texts and nothing but the text. Without rows of both labels, every score is the share of toxic
labels, zero if there are none. Null texts are empty. Labels that are null or of unknown documents do not count;
a document with several labels is toxic if one says so.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderpulse.llm.common import id_and_text, pieces, record_batch

SIZES = (3, 4, 5, 6, 7)
LEVELS = 4  # an n-gram's feature of level k says that it occurs at least 2**k times
BITS = 20
MAX_ROWS = 20_000
FEATURES = 8192
SMOOTHING = 1.0
WORK_BYTES = 512 << 10  # texts counted at a time: each character has one n-gram of every size
LONG_TEXT = 1 << 18  # characters
_SPACE = np.uint32(32)


def occurrences(texts: list[str | None]) -> Iterator[np.ndarray]:
    """For each n-gram size, text index << BITS | bucket of all occurrences; texts are lower-cased and padded with spaces."""
    lowered = [f" {(t or '').lower()} " for t in texts]
    lengths = np.array([len(t) for t in lowered], np.int64)
    chars = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32).copy()
    chars[(chars <= 13) & (chars >= 9)] = _SPACE
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)
    code = np.full(len(chars), 0x811C9DC5, np.uint32)
    for n in range(1, min(max(SIZES), len(chars)) + 1):
        last = len(chars) - n + 1
        code = (code[:last] ^ chars[n - 1 :]) * np.uint32(0x01000193)
        code ^= code >> np.uint32(15)
        if n in SIZES:
            inside = owner[:last] == owner[n - 1 :]
            found = (code[inside] * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
            yield owner[:last][inside].astype(np.int64) << BITS | found


def buckets(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(text index, bucket) of every n-gram occurrence."""
    keys = np.concatenate([np.zeros(0, np.int64), *occurrences(texts)])
    return keys >> BITS, keys & (1 << BITS) - 1


def _levels(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    reached = [(keys[times >= 1 << k], k) for k in range(LEVELS)]
    owner = np.concatenate([x >> BITS for x, _ in reached])
    return owner, np.concatenate([(x & (1 << BITS) - 1) * LEVELS + k for x, k in reached])


def present(owners: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) once each: a bucket's features, by how often it occurs in the text."""
    return _levels(*np.unique(owners << BITS | found, return_counts=True))


def text_features(texts: list[str | None], wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) once each, of the buckets that `wanted` marks (all by default).

    A long text by itself is counted size by size into all buckets: memory then grows with its characters only.
    """
    keys = occurrences(texts)
    if wanted is not None:
        keys = (x[wanted[x & (1 << BITS) - 1]] for x in keys)
    if len(texts) == 1 and len(texts[0] or "") > LONG_TEXT:
        total = sum((np.bincount(x, minlength=1 << BITS) for x in keys), np.zeros(1 << BITS, np.int64))
        once = np.flatnonzero(total)
        return _levels(once, total[once])
    return _levels(*np.unique(np.concatenate([np.zeros(0, np.int64), *keys]), return_counts=True))


@dataclass(frozen=True)
class Model:
    """score = sigmoid(intercept + sum of the weights of the features that a text has)."""

    intercept: float
    index: np.ndarray
    weight: np.ndarray

    def dense(self) -> np.ndarray:
        out = np.zeros(LEVELS << BITS)
        out[self.index] = self.weight
        return out


def score_texts(dense: np.ndarray, intercept: float, texts: list[str | None]) -> np.ndarray:
    owners, found = text_features(texts, dense.reshape(-1, LEVELS).any(axis=1))
    total = intercept + np.bincount(owners, weights=dense[found], minlength=len(texts))
    return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def training_labels(labels: DataFrame, max_rows: int) -> DataFrame:
    """(doc_id, toxic) of at most about max_rows documents that are not held out."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    rows = rows.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(~held_out())
    rows = rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = max_rows / max(1, rows.count())
    return rows if share >= 1 else rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))


def count_buckets(rows: DataFrame) -> DataFrame:
    """(bucket, toxic, other): how many texts of either label hold each bucket. rows: text, toxic."""
    schema = pa.schema([("bucket", pa.int64()), ("toxic", pa.int64()), ("other", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, LEVELS << BITS), np.int32)
        for batch in batches:
            for part in pieces(batch, size=WORK_BYTES):
                toxic = part["toxic"].to_numpy().astype(np.int64)
                owners, found = text_features(part["text"].to_pylist())
                for k in (0, 1):
                    np.add.at(total[k], found[toxic[owners] == k], 1)
        held = np.flatnonzero(total.any(axis=0))
        for at in range(0, len(held), 100_000):
            some = held[at : at + 100_000]
            yield record_batch(schema, [some, total[1, some], total[0, some]])

    counted = rows.select("text", "toxic").mapInArrow(run, "bucket long, toxic long, other long")
    return counted.groupBy("bucket").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def log_count_ratios(counts: DataFrame, n_toxic: int, n_other: int, features: int) -> list:
    """(bucket, ratio) of the buckets whose ratio is largest against its standard error. At most `features` rows."""
    p, q = F.col("toxic") + SMOOTHING, F.col("other") + SMOOTHING
    ratio = F.log(p / (n_toxic + 2 * SMOOTHING)) - F.log(q / (n_other + 2 * SMOOTHING))
    certain = F.abs(ratio) / F.sqrt(1 / p + 1 / q)
    best = counts.select("bucket", ratio.alias("ratio"), certain.alias("certain"))
    return best.orderBy(F.desc("certain"), "bucket").limit(features).select("bucket", "ratio").collect()


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, features: int = FEATURES) -> Model:
    """A model from the labelled documents that are not held out."""
    known = training_labels(labels, max_rows)
    rows = id_and_text(docs).join(F.broadcast(known), "doc_id").select("text", "toxic")
    numbers = rows.agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic")).first()
    n, n_toxic = numbers["n"], numbers["toxic"] or 0
    if not 0 < n_toxic < n:
        share = min(max(n_toxic / (n + 1e-9), 1e-9), 1 - 1e-9)
        return Model(float(np.log(share / (1 - share))), np.zeros(0, np.int64), np.zeros(0))
    ratios = sorted(log_count_ratios(count_buckets(rows), n_toxic, n - n_toxic, features))
    index = np.array([r["bucket"] for r in ratios], np.int64)
    scale = np.array([r["ratio"] for r in ratios])

    def vector(text: str | None) -> SparseVector:
        found = np.sort(text_features([text])[1])
        at = np.searchsorted(index, found)
        at = at[index[np.minimum(at, len(index) - 1)] == found]
        return SparseVector(len(index), at, scale[at])

    vectors = rows.select(F.udf(vector, VectorUDT())("text").alias("features"), F.col("toxic").cast("double").alias("label"))
    regression = LogisticRegression(regParam=1e-3, maxIter=60, standardization=False, aggregationDepth=2)
    fitted = regression.fit(vectors)
    return Model(float(fitted.intercept), index, fitted.coefficients.toArray() * scale)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) for every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = model.dense()
        for batch in batches:
            for part in pieces(batch, size=WORK_BYTES):
                yield record_batch(schema, [part["doc_id"], score_texts(dense, model.intercept, part["text"].to_pylist())])

    return id_and_text(docs).mapInArrow(run, "doc_id long, score double")
