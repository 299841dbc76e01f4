"""Streaming runs over the given events: landing, cleaning, replay and late rows.

Each run delivers event files into a fresh folder, lets the stream take them, and returns
a batch read of what it wrote.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderpulse import schemas
from orderpulse.functions.clock import as_time
from orderpulse.operators import facts
from orderpulse.plans import duck
from orderpulse.session import work_folder
from orderpulse.sources import landing, testdata
from orderpulse.sources.events import stream_events, write_events
from orderpulse.streaming.flows import append, run_available, silver_stream
from orderpulse.streaming.merge import merge_stream, read_ledger, read_table

HALF = datetime(2024, 1, 15)


def landed(spark, sf_dir) -> tuple[DataFrame, str]:
    """Lines of event files, landed by a stream; the rows, and the folder of the files."""
    base = work_folder(spark, "landing")
    testdata.delivered_lines(spark, sf_dir).write.text(f"{base}/raw")
    flow = append(landing.stream_landing(spark, f"{base}/raw"), f"{base}/checkpoint", f"{base}/bronze")
    run_available(flow)
    return spark.read.parquet(f"{base}/bronze"), f"{base}/raw"


def landing_rescue(spark, sf_dir) -> DataFrame:
    """What the typed event does not hold comes back, line by line."""
    rows = landing.rescued_rows(landed(spark, sf_dir)[0])
    return rows.select(
        "event_id", F.col("payload.gmv").alias("gmv"), F.col("payload.items")[0]["menu_item_id"].alias("first_item"),
        "rescued", "corrupt_record",
    )


def landing_types(spark, sf_dir) -> DataFrame:
    """Every landed row, with the payload read from its VARIANT."""
    rows = landed(spark, sf_dir)[0].filter("corrupt_record IS NULL")
    return rows.selectExpr(
        "event_id", "event_type", "payload.gmv AS gmv", "try_variant_get(payload_raw, '$.gmv', 'string') AS gmv_as_sent",
        "try_variant_get(payload_raw, '$.items[0].spice', 'int') AS spice",
        "try_variant_get(payload_raw, '$.channel.name', 'string') AS channel",
    )


def landing_drift(spark, sf_dir) -> DataFrame:
    """Paths and types of all delivered lines."""
    return landing.drift_profile(spark.read.text(landed(spark, sf_dir)[1]))


class Delivery:
    """A raw folder and the two flows behind it, run once per delivery."""

    def __init__(self, spark: SparkSession) -> None:
        base = work_folder(spark, "stream")
        self.spark = spark
        self.raw, self.bronze, self.silver = f"{base}/raw", f"{base}/bronze", f"{base}/silver"
        self.progress: list = []

    def land(self, events: DataFrame, by_hour: bool = False) -> None:
        write_events(events, self.raw, by_hour)
        arriving = stream_events(self.spark, self.raw)
        run_available(append(arriving, f"{self.bronze}-checkpoint", self.bronze))

    def clean(self) -> None:
        landed = self.spark.readStream.schema(schemas.RAW_EVENT).parquet(self.bronze)
        flow = append(silver_stream(landed), f"{self.silver}-checkpoint", self.silver)
        self.progress += run_available(flow)

    def read(self, path: str) -> DataFrame:
        return self.spark.read.parquet(path)


def _halves(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Stored, so that several deliveries of one half do not derive it from the tables again."""
    events = testdata.bronze_events(spark, sf_dir)
    folder = work_folder(spark, "halves")
    events.write.parquet(folder)
    events = spark.read.schema(events.schema).parquet(folder)
    border = F.date_format(as_time(HALF), testdata.TIME_TEXT)
    return events.filter(F.col("occurred_at") < border), events.filter(F.col("occurred_at") >= border)


def stream_bronze_ingest(spark, sf_dir) -> DataFrame:
    run = Delivery(spark)
    run.land(testdata.bronze_events(spark, sf_dir), by_hour=True)
    landed = run.read(run.bronze)
    return landed.select(
        "event_id", "event_type", "order_id", "occurred_at", "customer_id", "vendor_id", "driver_id",
        F.col("payload.gmv").alias("gmv"), F.col("payload.reason").alias("cancel_reason"),
    )


def stream_silver(spark, sf_dir) -> DataFrame:
    run = Delivery(spark)
    run.land(testdata.bronze_events(spark, sf_dir))
    run.clean()
    return run.read(run.silver).drop("items")


def stream_silver_items(spark, sf_dir) -> DataFrame:
    """Baskets that came through both streams, one row per item."""
    run = Delivery(spark)
    run.land(testdata.bronze_events(spark, sf_dir))
    run.clean()
    return facts.order_items(run.read(run.silver))


def stream_replay(spark, sf_dir) -> DataFrame:
    """The first delivery comes again after the second; it must add nothing."""
    run = Delivery(spark)
    early, late = _halves(spark, sf_dir)
    for part in (early, late, early):
        run.land(part)
        run.clean()
    return run.read(run.silver).drop("items")


def stream_late_drop(spark, sf_dir) -> DataFrame:
    """Early rows under new ids arrive after the late half; all are behind the watermark."""
    run = Delivery(spark)
    early, late = _halves(spark, sf_dir)
    renamed = early.withColumn("event_id", F.concat(F.lit("late-"), "event_id"))
    for part in (early, late, renamed):
        run.land(part)
        run.clean()
    return run.read(run.silver).drop("items")


def merged(spark, sf_dir) -> str:
    """Both halves, each with a part of its own rows once more inside the watermark, then the first again; the table's folder."""
    base = work_folder(spark, "merge")
    early, late = _halves(spark, sf_dir)
    repeated = F.right("event_id", F.lit(1)).isin("3", "6")
    for number, part in enumerate((early, early.filter(repeated), late.union(late.filter(repeated)), early)):
        write_events(part, f"{base}/raw-{number}", by_hour=False)
        arriving = landing.stream_landing(spark, f"{base}/raw-*")
        run_available(merge_stream(arriving, f"{base}/silver", f"{base}/checkpoint"))
    return f"{base}/silver"


def stream_merge(spark, sf_dir) -> DataFrame:
    return read_table(spark, merged(spark, sf_dir)).drop("event_date", "batch_id", "items")


def stream_merge_ledger(spark, sf_dir) -> DataFrame:
    """What the batches took, dropped and wrote."""
    rows = read_ledger(spark, merged(spark, sf_dir)).filter("input > 0")
    return rows.select("batch_id", "input", "late", "repeated", "written")


QUERIES = {
    "landing_rescue": landing_rescue,
    "landing_types": landing_types,
    "landing_drift": landing_drift,
    "stream_bronze_ingest": stream_bronze_ingest,
    "stream_silver": stream_silver,
    "stream_silver_items": stream_silver_items,
    "stream_replay": stream_replay,
    "stream_merge": stream_merge,
    "stream_merge_ledger": stream_merge_ledger,
    "stream_late_drop": stream_late_drop,
}

# The lines that testdata.delivered_lines writes, by their parts.
_LINES = """WITH parts AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(props->>'$.k' AS INTEGER) AS k,
    CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) AS cents, event_type AS name FROM events
),
lines AS (
  SELECT *,
    CASE name WHEN 'view' THEN 'order_placed' WHEN 'click' THEN 'order_confirmed'
         WHEN 'signup' THEN CASE WHEN k < 50 THEN 'order_prepared' ELSE 'order_picked_up' END
         WHEN 'purchase' THEN 'order_delivered'
         ELSE CASE WHEN k < 90 THEN 'order_cancelled' WHEN k < 95 THEN 'basket_reordered' ELSE 'tip_requested' END
    END AS kind,
    CASE k % 10 WHEN 4 THEN '"' || cents || ' EUR"' WHEN 5 THEN cents || '.5' ELSE cents END AS gmv_sent,
    CASE WHEN k % 10 IN (7, 8) THEN 'm' || k END AS item
  FROM parts
)
"""
_WHOLE = """'{"event_id":"' || event_id || '","event_type":"' || kind || '","payload":{"estimated_prep_minutes":41,"gmv":' || gmv_sent || '}}'"""
_TORN = f"left({_WHOLE}, length({_WHOLE}) - 3)"

_SILVER = duck.with_tables(duck.EVENTS) + "SELECT * FROM silver"

ORACLES = {
    "landing_rescue": _LINES
    + f"""SELECT CASE WHEN k NOT IN (41, 42) THEN event_id END AS event_id,
      CASE WHEN k NOT IN (41, 42) AND k % 10 NOT IN (4, 5) THEN CAST(cents AS BIGINT) END AS gmv,
      CASE WHEN k NOT IN (41, 42) THEN item END AS first_item,
      CASE WHEN k IN (41, 42) THEN NULL
        WHEN k % 10 = 3 THEN '{{"app_version":' || k || '}}'
        WHEN k % 10 IN (4, 5) THEN '{{"payload.gmv":' || gmv_sent || '}}'
        WHEN k % 10 = 6 THEN '{{"payload.channel":{{"name":"web"}}}}'
        WHEN k % 10 = 7 THEN '{{"payload.items":[{{"menu_item_id":"' || item || '","quantity":1,"spice":2}}]}}' END AS rescued,
      CASE k WHEN 41 THEN {_TORN} WHEN 42 THEN '[' || event_id || ']' END AS corrupt_record
    FROM lines WHERE k IN (41, 42) OR k % 10 IN (3, 4, 5, 6, 7)""",
    "landing_types": _LINES
    + """SELECT event_id, kind AS event_type, CASE WHEN k % 10 NOT IN (4, 5) THEN CAST(cents AS BIGINT) END AS gmv,
      replace(gmv_sent, '"', '') AS gmv_as_sent, CASE WHEN k % 10 = 7 THEN 2 END AS spice,
      CASE WHEN k % 10 = 6 THEN 'web' END AS channel
    FROM lines WHERE k NOT IN (41, 42)""",
    "landing_drift": _LINES
    + """, whole AS (SELECT * FROM lines WHERE k NOT IN (41, 42)),
    seen AS (
      SELECT unnest(['event_id', 'event_type', 'payload', 'payload.estimated_prep_minutes']) AS path,
        unnest(['STRING', 'STRING', 'OBJECT', 'BIGINT']) AS type, true AS fits FROM whole
      UNION ALL SELECT 'payload.gmv', CASE k % 10 WHEN 4 THEN 'STRING' WHEN 5 THEN 'DECIMAL' ELSE 'BIGINT' END,
        k % 10 NOT IN (4, 5) FROM whole
      UNION ALL SELECT 'app_version', 'BIGINT', false FROM whole WHERE k % 10 = 3
      UNION ALL SELECT 'payload.channel', 'OBJECT', false FROM whole WHERE k % 10 = 6
      UNION ALL SELECT 'payload.items', 'ARRAY', k % 10 = 8 FROM whole WHERE k % 10 IN (7, 8)
      UNION ALL SELECT '$', 'CORRUPT', false FROM lines WHERE k IN (41, 42)
    )
    SELECT path, type, fits, count(*) AS rows FROM seen GROUP BY ALL""",
    "stream_bronze_ingest": duck.with_tables(duck.EVENTS)
    + """SELECT event_id, event_type, order_id,
           strftime(occurred_at, '%Y-%m-%dT%H:%M:%S.%fZ') AS occurred_at,
           customer_id, vendor_id, driver_id, gmv, cancel_reason FROM silver""",
    "stream_silver": _SILVER,
    "stream_silver_items": duck.with_tables(duck.EVENTS)
    + """SELECT concat_ws('-', CAST(user_id AS VARCHAR), CAST(CAST(ts AS DATE) AS VARCHAR)) AS order_id,
      CAST(user_id AS VARCHAR) AS customer_id,
      CASE WHEN k = 77 THEN 'vendor-unlisted' ELSE CAST(user_id % 10 AS VARCHAR) END AS vendor_id, ts AS occurred_at,
      'm' || (k + i) AS menu_item_id, 'dish ' || i AS item_name, i AS quantity, cents AS unit_price, cents * i AS line_total
    FROM (SELECT *, unnest(range(1, k % 3 + 2)) AS i FROM kinds WHERE kind = 'order_placed')""",
    "stream_replay": _SILVER,
    "stream_merge": _SILVER,
    "stream_merge_ledger": duck.with_tables(duck.EVENTS)
    + """, sent AS (SELECT occurred_at AS t, occurred_at >= '2024-01-15' AS late_half,
        right(event_id, 1) IN ('3', '6') AS again FROM silver),
    ends AS (SELECT max(t) FILTER (NOT late_half) - INTERVAL 1 HOUR AS first, max(t) - INTERVAL 1 HOUR AS last FROM sent)
    SELECT 0::BIGINT AS batch_id, count(*) AS input, 0::BIGINT AS late, 0::BIGINT AS repeated, count(*) AS written
      FROM sent WHERE NOT late_half
    UNION ALL SELECT 1, count(*), count(*) FILTER (t < first), count(*) FILTER (t >= first), 0
      FROM sent, ends WHERE NOT late_half AND again
    UNION ALL SELECT 2, count(*) + count(*) FILTER (again), 0, count(*) FILTER (again), count(*) FROM sent WHERE late_half
    UNION ALL SELECT 3, count(*), count(*) FILTER (t < last), count(*) FILTER (t >= last), 0
      FROM sent, ends WHERE NOT late_half""",
    "stream_late_drop": _SILVER,
}
