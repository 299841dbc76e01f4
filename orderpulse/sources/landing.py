"""Lossless landing: whatever a delivered line holds can be read from its landed row.

A line is parsed once as a VARIANT and once into the typed event. The typed columns serve readers; beside them a row has

- `payload_raw`: the payload as a VARIANT, whatever its shape;
- `rescued`: what the typed columns do not hold, as a map from path to VARIANT: keys outside the schema and values of
  another type, on the top level, in the payload and in its items (then the items as a whole);
- `corrupt_record`: the line itself if it is not a JSON object, torn lines included; all other columns are then NULL.

A string column takes any scalar, a number column whole numbers only, and an array column arrays. JSON null fits all.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from orderpulse import schemas

FILES_PER_BATCH = 1_000  # new files that one micro-batch takes, so that a backlog is loaded in bounded steps
_OBJECT = "map<string, variant>"


@cache
def _event() -> StructType:
    return StructType.fromDDL(schemas.RAW_EVENT)


def _payload() -> StructType:
    return _event()["payload"].dataType


def _item() -> StructType:
    return _payload()["items"].dataType.elementType


def _fits(value: Column, kind) -> Column:
    shape = F.schema_of_variant(value)
    if isinstance(kind, LongType):
        return shape.isin("BIGINT", "VOID")
    if isinstance(kind, ArrayType):
        items = F.try_variant_get(value, "$", f"array<{_OBJECT}>")
        whole = F.forall(items, lambda item: F.forall(F.map_entries(item), _entry(_item())))
        return (shape == "VOID") | F.coalesce(whole, F.lit(False))
    if isinstance(kind, StructType):
        return shape.startswith("OBJECT") | (shape == "VOID")
    return ~(shape.startswith("OBJECT") | shape.startswith("ARRAY"))


def _known(key: Column, value: Column, schema: StructType) -> Column:
    """Whether the schema has the key, for a value of its type."""
    kinds: dict[str, list] = {}
    for field in schema.fields:
        kinds.setdefault(field.dataType.simpleString(), []).append(field)
    held = [F.when(key.isin(*[f.name for f in fields]), _fits(value, fields[0].dataType)) for fields in kinds.values()]
    return F.coalesce(*held, F.lit(False))


def _entry(schema: StructType):
    return lambda e: _known(e["key"], e["value"], schema)


def _unknown(schema: StructType):
    return lambda key, value: ~_known(key, value, schema)


def _type(value: Column) -> Column:
    """Name of a value's type, without what an object, an array or a number holds."""
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def _seen(prefix: str, schema: StructType):
    return lambda e: F.struct(
        F.concat(F.lit(prefix), e["key"]).alias("path"), _type(e["value"]).alias("type"), _entry(schema)(e).alias("fits")
    )


def _paths(body: Column) -> list[tuple[str, Column, StructType]]:
    """Prefix, keys with values, and schema of each object that a line may hold."""
    return [
        ("", F.try_variant_get(body, "$", _OBJECT), _event()),
        ("payload.", F.try_variant_get(body, "$.payload", _OBJECT), _payload()),
    ]


def _prefixed(prefix: str, values: Column) -> Column:
    values = F.transform_keys(values, lambda k, _: F.concat(F.lit(prefix), k)) if prefix else values
    return F.coalesce(values, F.create_map().cast(_OBJECT))


def _body() -> Column:
    """The line as a VARIANT, NULL unless it is an object. Parsed once: an object is what begins with a brace."""
    return F.when(F.col("value").rlike(r"^[ \t\r\n]*\{"), F.try_parse_json("value"))


def with_body(lines: DataFrame) -> DataFrame:
    """`value` with the parsed `body`, which is NULL unless the line is an object."""
    return lines.select("value", _body().alias("body"))


def parse_lines(lines: DataFrame) -> DataFrame:
    """Landed rows of the text column `value`; blank lines are no rows."""
    lines = with_body(lines.filter(F.trim("value") != ""))
    body = F.col("body")
    rescued = F.map_concat(*[_prefixed(prefix, F.map_filter(values, _unknown(schema))) for prefix, values, schema in _paths(body)])
    event = F.when(body.isNotNull(), F.from_json("value", schemas.RAW_EVENT))
    typed = lines.select("value", "body", event.alias("event"))
    return typed.select(
        "event.*",
        F.try_variant_get(body, "$.payload", "variant").alias("payload_raw"),
        F.when(F.size(rescued) > 0, rescued).alias("rescued"),
        F.when(body.isNull(), F.col("value")).alias("corrupt_record"),
    )


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    return parse_lines(spark.read.option("recursiveFileLookup", True).text(path))


def stream_landing(spark: SparkSession, path: str, files_per_batch: int | None = FILES_PER_BATCH) -> DataFrame:
    """New files as they arrive, oldest first."""
    reader = spark.readStream.option("recursiveFileLookup", True)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return parse_lines(reader.text(path))


def whole_records(landed: DataFrame) -> DataFrame:
    """Landed rows that are records; torn lines stay in the landing table only."""
    return landed.filter("corrupt_record IS NULL") if "corrupt_record" in landed.columns else landed


def rescued_rows(landed: DataFrame) -> DataFrame:
    """The rows that the typed columns do not hold whole, with `rescued` as JSON text."""
    some = landed.filter(F.col("corrupt_record").isNotNull() | F.col("rescued").isNotNull())
    return some.withColumn("rescued", F.to_json("rescued"))


def drift_profile(lines: DataFrame) -> DataFrame:
    """Rows per path and type of value, and whether the schema takes it; lines that are no objects have the path '$'."""
    lines = with_body(lines.filter(F.trim("value") != ""))
    body, found = F.col("body"), []
    for prefix, values, schema in _paths(body):
        entries = F.coalesce(F.map_entries(values), F.array().cast("array<struct<key: string, value: variant>>"))
        found.append(F.transform(entries, _seen(prefix, schema)))
    torn = F.array(F.struct(F.lit("$").alias("path"), F.lit("CORRUPT").alias("type"), F.lit(False).alias("fits")))
    entries = F.when(body.isNull(), torn).otherwise(F.concat(*found))
    seen = lines.select(F.inline(entries))
    return seen.groupBy("path", "type", "fits").agg(F.count(F.lit(1)).alias("rows"))
