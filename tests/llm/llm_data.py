"""Small tables for the tests of the text operators."""

import os

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def docs_frame(spark, texts, ids=None, extra=None):
    """Rows shaped like `documents`; `extra` names a further column that clashes with a result column."""
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "en", f"src{k % 3}", None if t is None else len(t)) for k, (i, t) in enumerate(zip(ids, texts))]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    if extra:
        from pyspark.sql import functions as F

        frame = frame.withColumn(extra, F.lit("clash"))
    return frame
