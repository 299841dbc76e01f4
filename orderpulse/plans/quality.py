"""Contracts and process checks as queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderpulse import vocabulary as v
from orderpulse.operators import checks, contracts, facts
from orderpulse.plans import duck
from orderpulse.plans.facts import orders
from orderpulse.sources import testdata


def _log(spark, sf_dir) -> DataFrame:
    return facts.order_event_log(testdata.silver_events(spark, sf_dir))


def orphan_keys(spark, sf_dir) -> DataFrame:
    return contracts.orphan_keys(
        orders(spark, sf_dir), "vendor_id", testdata.vendors(spark, sf_dir), "vendor_id"
    )


def dq_relationships(spark, sf_dir) -> DataFrame:
    parents = {
        "vendor_id": (testdata.vendors(spark, sf_dir), "vendor_id"),
        "customer_id": (testdata.customers(spark, sf_dir), "customer_id"),
        "driver_id": (testdata.drivers(spark, sf_dir), "driver_id"),
    }
    return contracts.relationship_failures(orders(spark, sf_dir), parents)


def dq_report(spark, sf_dir) -> DataFrame:
    silver = testdata.silver_events(spark, sf_dir)
    tables = {
        "silver": silver,
        "fct_order_events": facts.order_event_log(silver),
        "fct_orders": facts.order_lifecycle(silver),
        "dim_vendor": testdata.vendors(spark, sf_dir),
        "dim_customer": testdata.customers(spark, sf_dir),
        "dim_driver": testdata.drivers(spark, sf_dir),
    }
    report = contracts.dq_report(
        tables, contracts.standard_contracts(), contracts.severity_for("prod")
    )
    repeated = contracts.dq_report(
        {"bronze": testdata.line_events(spark, sf_dir)},
        [contracts.Unique("bronze", "event_id")],
        contracts.severity_for("ci"),
    )
    return report.unionByName(repeated)


def known_issues(spark, sf_dir) -> DataFrame:
    return checks.known_issues(
        orders(spark, sf_dir), _log(spark, sf_dir), testdata.vendors(spark, sf_dir)
    )


def amount_identity(spark, sf_dir) -> DataFrame:
    lines = testdata.order_lines(spark, sf_dir)
    return (
        checks.amount_mismatches(orders(spark, sf_dir))
        .unionByName(checks.line_mismatches(lines))
        .unionByName(checks.food_cost_mismatches(testdata.order_facts(spark, sf_dir), lines))
    )


QUERIES = {
    "orphan_keys": orphan_keys,
    "known_issues": known_issues,
    "dq_unique": lambda s, d: contracts.unique_failures(testdata.line_events(s, d), "event_id"),
    "dq_not_null": lambda s, d: contracts.not_null_failures(_log(s, d), "customer_id"),
    "dq_accepted_values": lambda s, d: contracts.accepted_values_failures(
        _log(s, d), "event_type", v.EVENT_TYPES, "occurred_at"
    ),
    "dq_accepted_range": lambda s, d: contracts.accepted_range_failures(
        orders(s, d).select("order_id", "vendor_id", "gmv", "discount"), "gmv", low=0
    ),
    "dq_relationships": dq_relationships,
    "dq_lifecycle_order": lambda s, d: contracts.expression_failures(
        orders(s, d).select("order_id", *v.STAGE_EVENTS), contracts.LIFECYCLE_ORDER
    ),
    "dq_report": dq_report,
    "illegal_transitions": lambda s, d: checks.illegal_transitions(testdata.silver_events(s, d)),
    "amount_identity": amount_identity,
    "conflicting_duplicates": lambda s, d: checks.conflicting_duplicates(testdata.line_events(s, d)),
    "conflicting_orders": lambda s, d: checks.conflicting_duplicates(
        testdata.line_events(s, d).withColumn("event_id", F.concat_ws("/", "customer_id", "vendor_id"))
    ),
    "null_key_profile": lambda s, d: checks.null_key_profile(_log(s, d)),
}

_UNKNOWN = f"event_type NOT IN ({duck.KNOWN_TYPES})"
_ORPHAN = "vendor_id IS NOT NULL AND vendor_id NOT IN (SELECT vendor_id FROM dim_vendor)"


def _orphans(key: str, dim: str) -> str:
    return (
        f"SELECT '{key}' AS key_name, {key} AS key_value, count(*) AS rows FROM fct_orders o "
        f"WHERE {key} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {dim} p WHERE p.{key} = o.{key}) "
        "GROUP BY 2"
    )


_LINKS = " UNION ALL ".join(
    _orphans(key, dim)
    for key, dim in (
        ("vendor_id", "dim_vendor"),
        ("customer_id", "dim_customer"),
        ("driver_id", "dim_driver"),
    )
)
_LEGAL = """(previous_type IS NULL AND event_type = 'order_placed')
  OR (previous_type, event_type) IN (
    ('order_placed', 'order_confirmed'), ('order_placed', 'order_cancelled'),
    ('order_confirmed', 'order_prepared'), ('order_confirmed', 'order_cancelled'),
    ('order_prepared', 'order_picked_up'), ('order_prepared', 'order_cancelled'),
    ('order_picked_up', 'order_delivered'))"""
_LATER = """placed_at <= confirmed_at AND confirmed_at <= prepared_at
  AND prepared_at <= picked_up_at AND picked_up_at <= delivered_at"""

ORACLES = {
    "orphan_keys": duck.with_tables(duck.ORDERS, duck.DIMENSIONS)
    + f"SELECT vendor_id, count(*) AS rows FROM fct_orders WHERE {_ORPHAN} GROUP BY 1",
    "known_issues": duck.with_tables(duck.ORDERS, duck.DIMENSIONS)
    + """, per_order AS (
            SELECT count(*) FILTER (WHERE o.gmv < 0) AS below,
              count(*) FILTER (WHERE o.vendor_id IS NOT NULL AND d.vendor_id IS NULL) AS unlisted
            FROM fct_orders o LEFT JOIN dim_vendor d ON o.vendor_id = d.vendor_id),
          per_event AS (
            SELECT count(*) FILTER (WHERE event_type NOT IN ('order_placed', 'order_confirmed', 'order_prepared',
              'order_picked_up', 'order_delivered', 'order_cancelled')) AS strange FROM silver)
          SELECT below AS negative_gmv, strange AS unknown_event_types, unlisted AS orphan_vendors,
            below + strange + unlisted AS total_issues FROM per_order, per_event""",
    "dq_unique": duck.with_tables(duck.LINE_EVENTS)
    + "SELECT event_id, count(*) AS copies FROM line_events GROUP BY 1 HAVING count(*) > 1",
    "dq_not_null": duck.with_tables(duck.EVENTS)
    + """SELECT event_id, event_type, order_id, occurred_at, customer_id, vendor_id, driver_id,
           cancelled_by, cancel_reason FROM silver WHERE customer_id IS NULL""",
    "dq_accepted_values": duck.with_tables(duck.EVENTS)
    + f"""SELECT event_type, count(*) AS rows, min(occurred_at) AS first_seen,
            max(occurred_at) AS last_seen FROM silver WHERE {_UNKNOWN} GROUP BY 1""",
    "dq_accepted_range": duck.with_tables(duck.ORDERS)
    + "SELECT order_id, vendor_id, gmv, discount FROM fct_orders WHERE gmv < 0",
    "dq_relationships": duck.with_tables(duck.ORDERS, duck.DIMENSIONS) + _LINKS,
    "dq_lifecycle_order": duck.with_tables(duck.ORDERS)
    + f"SELECT order_id, placed_at, confirmed_at, prepared_at, picked_up_at, delivered_at, cancelled_at FROM fct_orders WHERE NOT ({_LATER})",
    "dq_report": duck.with_tables(duck.ORDERS, duck.DIMENSIONS, duck.LINE_EVENTS)
    + f""", links AS ({_LINKS}),
        counts AS (
          SELECT 'unique' AS contract, 'silver' AS table_name, 'event_id' AS column_name,
            (SELECT count(*) FROM (SELECT event_id FROM silver WHERE event_id IS NOT NULL
               GROUP BY 1 HAVING count(*) > 1)) AS failures, 'warn' AS severity
          UNION ALL SELECT 'not_null', 'silver', 'event_id',
            (SELECT count(*) FROM silver WHERE event_id IS NULL), 'warn'
          UNION ALL SELECT 'accepted_values', 'fct_order_events', 'event_type',
            (SELECT count(DISTINCT event_type) FROM silver WHERE {_UNKNOWN}), 'warn'
          UNION ALL SELECT 'accepted_range', 'fct_orders', 'gmv',
            (SELECT count(*) FROM fct_orders WHERE gmv < 0), 'warn'
          UNION ALL SELECT 'expression_is_true', 'fct_orders', 'lifecycle_order',
            (SELECT count(*) FROM fct_orders WHERE NOT ({_LATER})), 'warn'
          UNION ALL SELECT 'relationships', 'fct_orders', key_name,
            CAST(coalesce((SELECT sum(rows) FROM links l WHERE l.key_name = k.key_name), 0) AS BIGINT),
            'warn' FROM (VALUES ('vendor_id'), ('customer_id'), ('driver_id')) k(key_name)
          UNION ALL SELECT 'unique', 'bronze', 'event_id',
            (SELECT count(*) FROM (SELECT event_id FROM line_events GROUP BY 1 HAVING count(*) > 1)),
            'error'
        )
        SELECT *, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'error' THEN 'fail'
                       ELSE 'warn' END AS status FROM counts""",
    "illegal_transitions": duck.with_tables(duck.EVENTS)
    + f"""SELECT * FROM (
            SELECT order_id, event_id, occurred_at, event_type,
              lag(event_type) OVER (PARTITION BY order_id ORDER BY occurred_at, event_id) AS previous_type
            FROM silver)
          WHERE NOT coalesce({_LEGAL}, FALSE)""",
    "amount_identity": duck.with_tables(duck.ORDERS, duck.LINES, duck.ORDER_FACTS)
    + """SELECT 'gmv' AS rule, order_id, food_cost + delivery_fee + service_fee - discount AS expected,
           gmv AS actual FROM fct_orders WHERE expected <> gmv
         UNION ALL SELECT 'line_total', order_id, unit_price * quantity, line_total
           FROM lines WHERE unit_price * quantity <> line_total
         UNION ALL SELECT 'food_cost', o.order_id, CAST(s.total AS BIGINT), o.food_cost
           FROM order_facts o JOIN (SELECT order_id, sum(line_total) AS total FROM lines GROUP BY 1) s
             ON o.order_id = s.order_id WHERE s.total <> o.food_cost""",
    "conflicting_duplicates": duck.with_tables(duck.LINE_EVENTS)
    + """SELECT event_id, count(*) AS copies,
           arg_min(order_id, order_id || event_type) AS first_order_id,
           min(event_type) AS first_event_type,
           arg_max(order_id, order_id || event_type) AS last_order_id,
           max(event_type) AS last_event_type
         FROM line_events GROUP BY 1 HAVING count(DISTINCT (order_id, event_type)) > 1""",
    "conflicting_orders": duck.with_tables(duck.LINE_EVENTS)
    + """SELECT id AS event_id, copies, low.o AS first_order_id, low.e AS first_event_type,
           high.o AS last_order_id, high.e AS last_event_type
         FROM (SELECT customer_id || '/' || vendor_id AS id, count(*) AS copies,
             min({'o': order_id, 'e': event_type}) AS low, max({'o': order_id, 'e': event_type}) AS high
           FROM line_events GROUP BY 1)
         WHERE low <> high""",
    "null_key_profile": duck.with_tables(duck.EVENTS)
    + """SELECT event_type, count(*) AS events,
           count(*) FILTER (WHERE customer_id IS NULL) AS no_customer,
           count(*) FILTER (WHERE vendor_id IS NULL) AS no_vendor,
           count(*) FILTER (WHERE driver_id IS NULL
             AND event_type IN ('order_picked_up', 'order_delivered')) AS no_driver_after_pickup
         FROM silver GROUP BY 1""",
}
