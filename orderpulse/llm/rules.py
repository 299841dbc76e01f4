"""Quality rules as a bitmask ledger, in DataFrame functions only.

Each text is measured once and every rule is evaluated once; its failures are bits of one integer. A policy is a
version's mask of rules: applying it, comparing versions and ablating single rules are bitwise operations on the
stored ledger and never read the texts again.

Words are runs of characters other than 0x20 and 0x09 to 0x0D. Null texts are empty. Each input row gives one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderpulse.llm.common import id_and_text

SPACES = r"[\x20\x09-\x0D]+"
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_upper", "n_exclaims",
)

# A rule's place is its bit, so rules are only ever appended. Each expression is true if a text fails.
RULES = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "100 * n_dup_lines > 40 * n_lines",
    "short_words": "word_chars < 3 * n_words",
    "long_words": "word_chars > 12 * n_words",
    "capitals": "2 * n_upper > n_letters",
    "exclaims": "2 * n_exclaims > n_words",
    "few_letters": "2 * n_letters < word_chars",
}
BIT = {name: 1 << i for i, name in enumerate(RULES)}
POLICIES = {
    "base": ("few_words", "repeated_words"),
    "v1": tuple(RULES),
}


def mask(policy: str) -> int:
    return sum(BIT[name] for name in POLICIES[policy])


def _count(text: Column, others: str) -> Column:
    """Characters left when all others are taken out."""
    return F.length(F.regexp_replace(text, others, "")).cast("long")


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and the measurements of every row."""
    rows = id_and_text(docs).withColumn("text", F.coalesce("text", F.lit("")))
    rows = rows.select(
        "doc_id", "text",
        F.filter(F.split("text", SPACES, -1), lambda w: w != "").alias("words"),
        F.filter(F.split("text", "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    rows = rows.withColumn("n", F.size("words")).withColumn("bits", F.length(F.bin(F.col("n").cast("long"))))
    # A window's hash, and in the low bits its place: sorting brings equal windows together.
    window = lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2))
    packed = F.transform(
        F.sequence(F.lit(0), F.col("n") - 3),
        lambda i: F.call_function("shiftleft", window(i), F.col("bits")).bitwiseOR(i.cast("long")),
    )
    rows = rows.withColumn("sorted", F.when(F.col("n") >= 3, F.sort_array(packed)).otherwise(F.array().cast("array<long>")))
    place = lambda x: (x - F.call_function("shiftleft", F.call_function("shiftright", x, F.col("bits")), F.col("bits"))).cast("int")

    def same(x: Column, y: Column) -> Column:
        """Both are the same three words; the hashes are compared first."""
        equal = F.call_function("shiftright", x, F.col("bits")) == F.call_function("shiftright", y, F.col("bits"))
        for k in range(3):
            equal = equal & (F.get("words", place(x) + k) == F.get("words", place(y) + k))
        return F.coalesce(equal, F.lit(False))

    twice = F.filter("sorted", lambda x, i: same(x, F.get("sorted", i + 1)) | ((i > 0) & same(x, F.get("sorted", i - 1))))
    rows = rows.withColumn("places", F.sort_array(F.transform(twice, place)))
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("total"))
    covered = F.aggregate(
        "places", start,
        lambda done, p: F.struct(p.alias("last"), (done.total + F.least(F.lit(3), p - done.last)).alias("total")),
        lambda done: done.total,
    )
    text = F.col("text")
    return rows.select(
        "doc_id",
        F.col("n").cast("long").alias("n_words"),
        _count(text, SPACES).alias("word_chars"),
        _count(text, r"[^#*$%&|<>]+").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        _count(text, r"\P{L}+").alias("n_letters"),
        _count(text, r"\P{Lu}+").alias("n_upper"),
        _count(text, r"[^!]+").alias("n_exclaims"),
    )


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements, and failed_bits: the bits of the rules that the row fails."""
    bits = sum((F.when(F.expr(rule), BIT[name]).otherwise(0) for name, rule in RULES.items()), F.lit(0))
    return measure(docs).withColumn("failed_bits", bits.cast("long"))


def apply_policy(rows: DataFrame, policy: str, column: str = "kept") -> DataFrame:
    """The ledger with the policy's verdict."""
    return rows.withColumn(column, F.col("failed_bits").bitwiseAND(F.lit(mask(policy))) == 0)


def ablation(rows: DataFrame, policy: str) -> DataFrame:
    """One row per rule of the policy: rows that fail it, that fail it alone, and that the policy would keep without it."""
    used = F.col("failed_bits").bitwiseAND(F.lit(mask(policy))).alias("bits")
    patterns = rows.groupBy(used).count()  # at most one row per combination of rules
    names = F.explode(F.map_from_arrays(*[F.array(*[F.lit(x) for x in xs]) for xs in (POLICIES[policy], [BIT[n] for n in POLICIES[policy]])]))
    each = patterns.select("bits", "count", names.alias("rule", "bit"))
    hit = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("count"))), F.lit(0))
    return each.groupBy("rule").agg(
        hit(F.col("bits").bitwiseAND(F.col("bit")) != 0).alias("fails"),
        hit(F.col("bits") == F.col("bit")).alias("fails_alone"),
        hit(F.col("bits").bitwiseAND(F.bitwise_not("bit")) == 0).alias("kept_without"),
    )


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM d),
wins AS (
  SELECT doc_id, p, w[p] AS a, w[p + 1] AS b, w[p + 2] AS c
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS p FROM m WHERE len(w) >= 3)),
twice AS (SELECT doc_id, p FROM wins QUALIFY count(*) OVER (PARTITION BY doc_id, a, b, c) >= 2),
cover AS (
  SELECT doc_id, count(DISTINCT p + k) AS n_repeat_words FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
measured AS (
  SELECT m.doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    CAST(len(ls) AS BIGINT) AS n_lines,
    CAST(length(regexp_replace(t, '\P{L}+', '', 'g')) AS BIGINT) AS n_letters,
    CAST(length(regexp_replace(t, '\P{Lu}+', '', 'g')) AS BIGINT) AS n_upper,
    CAST(length(regexp_replace(t, '[^!]+', '', 'g')) AS BIGINT) AS n_exclaims
  FROM m LEFT JOIN cover ON m.doc_id = cover.doc_id),
failed AS (
  SELECT *, CAST(
    CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN 100 * n_dup_lines > 40 * n_lines THEN 8 ELSE 0 END
    + CASE WHEN word_chars < 3 * n_words THEN 16 ELSE 0 END + CASE WHEN word_chars > 12 * n_words THEN 32 ELSE 0 END
    + CASE WHEN 2 * n_upper > n_letters THEN 64 ELSE 0 END + CASE WHEN 2 * n_exclaims > n_words THEN 128 ELSE 0 END
    + CASE WHEN 2 * n_letters < word_chars THEN 256 ELSE 0 END AS BIGINT) AS failed_bits
  FROM measured)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, failed_bits = 0 AS kept FROM failed
"""
