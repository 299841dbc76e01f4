"""Quality classifier by co-training of two views.

One logistic regression sees the text (shares of characters, repetition of words and lines), another the page metadata
(language, source, size class). Both start from labelled rows. In every round each view labels those unlabelled rows
it is confident about, and the other view learns from them. Afterwards each view is calibrated on labelled rows that
neither has learned from, and a last regression on the two calibrated log-odds scores all documents.

`max_rows` bounds the labelled and the unlabelled rows of the fit; scoring covers every row and whole texts. A fifth of
the labels, those with crc32(doc_id as text) mod 5 = 0, is never used and can measure the result. Null texts are empty;
null metadata is a value of its own. Without training labels of both kinds every document gets the share of good labels (one half if
there are none) and is kept if that is at least one half. Documents with contradictory labels count as bad.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderpulse.llm.common import record_batch, stored
from orderpulse.llm.toxicity import held_out

MAX_ROWS = 10_000
ROUNDS = 3
CONFIDENT = 0.95
TEXT_SIZE, META_SIZE = 128 + 6, 16 + 64 + 24
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def text_features(text: bytes) -> np.ndarray:
    out = np.zeros(TEXT_SIZE)
    if not text:
        return out
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=128)
    out[:128] = np.sqrt(counts[:128] / len(text))
    words, lines = text.split(), [line for line in text.split(b"\n") if line]
    out[128] = 1 - counts[:128].sum() / len(text)
    out[129] = np.log1p(len(words)) / 10
    if words:
        out[130] = len(set(words)) / len(words)
        out[131] = min(2.0, (len(text) - len(words)) / len(words) / 10)
        pairs = len(words) - 1
        out[132] = len(set(zip(words, words[1:]))) / pairs if pairs else 1
    out[133] = len(set(lines)) / len(lines) if lines else 1
    return out


def meta_features(lang: str | None, source: str | None, n_chars: int | None) -> np.ndarray:
    out = np.zeros(META_SIZE)
    out[crc32((lang or "").encode()) % 16] = 1
    out[16 + crc32((source or "").encode()) % 64] = 1
    out[80 + (0 if n_chars is None else min(23, 1 + max(0, int(n_chars)).bit_length()))] = 1
    return out


def _views(batch: pa.RecordBatch, at: int, n: int = 500) -> tuple[np.ndarray, np.ndarray]:
    part = batch.slice(at, n)
    texts = [t or b"" for t in part["text"].cast(pa.large_binary()).to_pylist()]
    rows = zip(part["lang"].to_pylist(), part["source"].to_pylist(), part["n_chars"].to_pylist())
    return np.stack([text_features(t) for t in texts]), np.stack([meta_features(*r) for r in rows])


def inputs(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"),
        F.col("n_chars").cast("long").alias("n_chars"),
    )


def features(rows: DataFrame) -> DataFrame:
    """doc_id, label, text_view and meta_view of rows with the input columns and a label."""
    schema = pa.schema([("doc_id", pa.int64()), ("label", pa.float64()),
                        ("text_view", pa.list_(pa.float64())), ("meta_view", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                text, meta = _views(batch, at)
                part = batch.slice(at, 500)
                yield record_batch(schema, [part["doc_id"], part["label"], list(text), list(meta)])

    return rows.select(*COLUMNS, "label").mapInArrow(
        run, "doc_id long, label double, text_view array<double>, meta_view array<double>"
    )


@dataclass(frozen=True)
class Model:
    """Linear views, and how their margins make a score: sigmoid(c[0] + c[1] * text margin + c[2] * metadata margin)."""

    text: np.ndarray
    meta: np.ndarray
    combined: tuple[float, float, float]

    def score(self, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
        a, b, c = self.combined
        total = a + b * (text @ self.text[:-1] + self.text[-1]) + c * (meta @ self.meta[:-1] + self.meta[-1])
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def _within(share: float, salt: str) -> Column:
    return F.pmod(F.xxhash64(F.lit(salt), F.col("doc_id")), F.lit(1 << 30)) < int(min(1.0, share) * (1 << 30))


def sample(docs: DataFrame, labels: DataFrame, max_rows: int) -> DataFrame:
    """Features of up to about max_rows labelled and as many unlabelled rows."""
    rows = inputs(docs)
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("label"))
    known = known.dropna().groupBy("doc_id").agg(F.min("label").alias("label"))
    usable = known.filter(~held_out())
    chosen = usable.filter(_within(max_rows / max(1, usable.count()), "labelled"))
    labelled = rows.join(F.broadcast(chosen), "doc_id")
    few = _within(max_rows / max(1, docs.count()), "unlabelled")
    unlabelled = rows.filter(few).join(known.filter(few).select("doc_id"), "doc_id", "left_anti")
    return stored(features(labelled.unionByName(unlabelled.withColumn("label", F.lit(None).cast("double")))), "views")


def _regression(rows: DataFrame, view: str):
    vectors = rows.select(array_to_vector(view).alias("features"), "label")
    return LogisticRegression(regParam=1e-3, maxIter=40).fit(vectors)


def _weights(model) -> np.ndarray:
    return np.r_[model.coefficients.toArray(), model.intercept]


def _margin(view: str, weights: np.ndarray) -> Column:
    literal = F.array(*[F.lit(float(w)) for w in weights[:-1]])
    pairs = F.zip_with(view, literal, lambda x, w: x * w)
    return F.aggregate(pairs, F.lit(float(weights[-1])), lambda total, x: total + x)


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, rounds: int = ROUNDS) -> Model:
    rows = sample(docs, labels, max_rows)
    known = rows.filter("label IS NOT NULL").withColumn("fold", F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(4)))
    train, check, unknown = known.filter("fold > 0"), known.filter("fold = 0"), rows.filter("label IS NULL")
    kinds = {fold: set() for fold in (True, False)}
    counts = known.groupBy((F.col("fold") > 0).alias("train"), "label").count().collect()
    for r in counts:
        kinds[r["train"]].add(r["label"])
    if len(kinds[True]) < 2 or len(kinds[False]) < 2:
        n = sum(r["count"] for r in counts)
        share = sum(r["count"] for r in counts if r["label"]) / n if n else 0.5
        share = min(max(share, 1e-9), 1 - 1e-9)
        return Model(np.zeros(TEXT_SIZE + 1), np.zeros(META_SIZE + 1), (float(np.log(share / (1 - share))), 0.0, 0.0))
    other = {"text_view": "meta_view", "meta_view": "text_view"}
    learned = {view: _regression(train, view) for view in other}
    for _ in range(rounds - 1):
        lessons = {}
        for view, model in learned.items():
            seen = unknown.withColumn("features", array_to_vector(view))
            sure = model.transform(seen).withColumn("p", vector_to_array("probability")[1])
            sure = sure.filter((F.col("p") >= CONFIDENT) | (F.col("p") <= 1 - CONFIDENT))
            lessons[other[view]] = sure.select("text_view", "meta_view", F.round("p").alias("label"))
        old = train.select("text_view", "meta_view", "label")
        learned = {view: _regression(old.union(lessons[view]), view) for view in other}
    text, meta = _weights(learned["text_view"]), _weights(learned["meta_view"])
    margins = check.select("label", _margin("text_view", text).alias("t"), _margin("meta_view", meta).alias("m"))
    margins = stored(margins, "margins")
    slopes = {v: _weights(_regression(margins.select(F.array(v).alias("x"), "label"), "x")) for v in ("t", "m")}
    calibrated = margins.select(F.array(*[_margin_of(v, slopes[v]) for v in ("t", "m")]).alias("x"), "label")
    b, c, a = _weights(_regression(calibrated, "x"))
    (st, it), (sm, im) = slopes["t"], slopes["m"]
    return Model(text, meta, (float(a + b * it + c * im), float(b * st), float(c * sm)))


def _margin_of(name: str, slope: np.ndarray) -> Column:
    return F.col(name) * float(slope[0]) + float(slope[1])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, kept) for every row: kept if the score is at least one half."""
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("kept", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                scores = model.score(*_views(batch, at))
                yield record_batch(schema, [batch.slice(at, 500)["doc_id"], scores, scores >= 0.5])

    return inputs(docs).mapInArrow(run, "doc_id long, score double, kept boolean")


def keep_good(docs: DataFrame, model: Model) -> DataFrame:
    """The rows that the model keeps, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                yield batch.slice(at, 500).filter(pa.array(model.score(*_views(batch, at)) >= 0.5))

    return docs.mapInArrow(run, docs.schema)
