"""Queries on time: as-of and interval joins, sessions, snapshots; each with its SQL twin.

The queries take awkward rows along: orders without a time, a buyer that many orders
share, times that many rows share.  ``ORDERS`` and ``SHIPPED`` state them in SQL.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.operators.asof import asof_join
from millrace.operators.cdc import scd2_history
from millrace.operators.intervals import interval_join, version_at
from millrace.operators.sessions import rolling_sums, session_summary
from millrace.operators.snapshots import snapshot_changes
from millrace.plans.tables import table

NO_TIME = "o_orderstatus = 'P' and o_orderpriority = '4-NOT SPECIFIED'"
HOUSE = "o_orderpriority in ('1-URGENT', '5-LOW')"

ORDERS = f"""
orders_ AS (
  SELECT o_orderkey AS order_key, CASE WHEN {HOUSE} THEN -1 WHEN o_orderstatus <> 'P' THEN o_custkey END AS buyer,
         CASE WHEN NOT ({NO_TIME}) THEN o_orderdate END AS ordered_at, o_totalprice AS price, o_orderpriority AS priority
  FROM orders
)"""
SHIPPED = f"""
{ORDERS},
shipped AS (
  SELECT buyer, l_shipdate AS shipped_at, order_key AS shipped_order, l_linenumber AS line, l_quantity AS units
  FROM lineitem JOIN orders_ ON l_orderkey = order_key
)"""


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of a buyer; urgent and low ones are on one house account, some have no time or buyer."""
    buyer = F.when(F.expr(HOUSE), -1).when(F.col("o_orderstatus") != "P", F.col("o_custkey"))
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_key"),
        buyer.alias("buyer"),
        F.when(~F.expr(NO_TIME), F.col("o_orderdate").cast("timestamp")).alias("ordered_at"),
        F.col("o_totalprice").alias("price"),
        F.col("o_orderpriority").alias("priority"),
    )


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as shipments to a buyer; a day has many."""
    lines = table(spark, sf_dir, "lineitem").join(
        orders(spark, sf_dir).select("order_key", "buyer"), F.expr("l_orderkey = order_key")
    )
    return lines.select(
        "buyer",
        F.col("l_shipdate").cast("timestamp").alias("shipped_at"),
        F.col("order_key").alias("shipped_order"),
        F.col("l_linenumber").alias("line"),
        F.col("l_quantity").alias("units"),
    )


def j_asof_shipment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order with the buyer's last shipment until then."""
    found = asof_join(
        orders(spark, sf_dir), shipments(spark, sf_dir), "buyer", "ordered_at", "shipped_at",
        tie=("shipped_order", "line"),
    )
    return found.drop("price", "priority")


J_ASOF_SHIPMENT = f"""
WITH {SHIPPED},
last AS (
  SELECT buyer, shipped_at, max({{'o': shipped_order, 'l': line, 'u': units}}) AS s FROM shipped
  WHERE buyer IS NOT NULL GROUP BY buyer, shipped_at
)
SELECT o.order_key, o.buyer, o.ordered_at, last.shipped_at, s.o AS shipped_order, s.l AS line, s.u AS units
FROM orders_ o ASOF LEFT JOIN last ON o.buyer = last.buyer AND o.ordered_at >= last.shipped_at"""


def j_asof_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every purchase with the user's last view in the six hours before it."""
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    bought = events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts", "value")
    viewed = events.filter("event_type = 'view'").select(
        "user_id", F.col("event_id").alias("view_id"), F.col("ts").alias("viewed_at"), F.col("value").alias("view_value")
    )
    return asof_join(
        bought, viewed, "user_id", "ts", "viewed_at", tie=("view_id",), strict=True,
        within=F.expr("interval 6 hours"), how="inner",
    )


J_ASOF_VIEW = """
WITH bought AS (SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'purchase'),
viewed AS (
  SELECT user_id, ts AS viewed_at, max({'i': event_id, 'v': value}) AS v FROM events
  WHERE event_type = 'view' GROUP BY user_id, ts
)
SELECT event_id, b.user_id, ts, value, v.i AS view_id, viewed_at, v.v AS view_value
FROM bought b ASOF JOIN viewed ON b.user_id = viewed.user_id AND b.ts > viewed_at
WHERE viewed_at + INTERVAL 6 HOURS >= ts"""


def j_version_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every shipment with the buyer's priority at that time, from a type-2 history of priorities."""
    log = orders(spark, sf_dir).select(
        "buyer", F.lit("UPDATE").alias("operation"), F.col("ordered_at").alias("updated_at"),
        F.col("order_key").alias("change_id"), F.col("priority").alias("valid_priority"),
    )
    versions = scd2_history(log, "buyer").drop("is_current")
    return version_at(shipments(spark, sf_dir), versions, "buyer", "shipped_at")


J_VERSION_AT = f"""
WITH {SHIPPED},
last AS (
  SELECT buyer, ordered_at AS valid_from, arg_max(priority, order_key) AS valid_priority
  FROM orders_ WHERE ordered_at IS NOT NULL AND buyer IS NOT NULL GROUP BY buyer, ordered_at
),
version AS (SELECT *, lead(valid_from) OVER (PARTITION BY buyer ORDER BY valid_from) AS valid_to FROM last)
SELECT s.*, v.valid_priority, v.valid_from, v.valid_to
FROM shipped s ASOF LEFT JOIN version v ON s.buyer = v.buyer AND s.shipped_at >= v.valid_from"""


def happenings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of users; clicks are on one shared account, some have no user or no time."""
    who = F.when(F.expr("event_type = 'click'"), -1).when(F.expr("not (event_type = 'error' and value < 10)"), F.col("user_id"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        who.alias("who"),
        F.when(F.expr("not (event_type = 'signup' and value < 5)"), F.col("ts").cast("timestamp")).alias("at"),
        "event_type",
        F.col("value").cast("decimal(12,2)").alias("value"),
    )


HAPPENINGS = """
happening AS (
  SELECT event_id, CASE WHEN event_type = 'click' THEN -1 WHEN NOT (event_type = 'error' AND value < 10) THEN user_id END AS who,
         CASE WHEN NOT (event_type = 'signup' AND value < 5) THEN ts END AS "at", event_type, CAST(value AS DECIMAL(12,2)) AS value
  FROM events
)"""


def j_interval_spells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases and clicks with all spells that hold them; spells overlap, are open, or end before they begin."""
    rows = happenings(spark, sf_dir)
    end = F.when(F.expr("event_type = 'view'"), F.col("at") + F.make_dt_interval(F.lit(0), F.floor("value").cast("int")))
    end = end.when(F.expr("event_type = 'error'"), F.col("at") - F.expr("interval 1 hour"))
    spells = rows.filter("event_type in ('view', 'error') or event_type = 'signup' and value >= 400")
    spells = spells.select("who", F.col("event_id").alias("spell_id"), F.col("at").alias("begins"), end.alias("ends"))
    points = rows.filter("event_type in ('purchase', 'click')").select("event_id", "who", "at")
    owner = F.when(F.col("who") == -1, F.col("event_id") % 50).otherwise(F.col("who"))
    return interval_join(points.withColumn("who", owner), spells, "who", "at", "begins", "ends", how="left")


J_INTERVAL_SPELLS = f"""
WITH {HAPPENINGS},
spell AS (
  SELECT who, event_id AS spell_id, "at" AS begins,
         CASE event_type WHEN 'view' THEN "at" + to_hours(CAST(floor(value) AS INTEGER)) WHEN 'error' THEN "at" - INTERVAL 1 HOUR END AS ends
  FROM happening WHERE event_type IN ('view', 'error') OR event_type = 'signup' AND value >= 400
),
point AS (
  SELECT event_id, CASE WHEN who = -1 THEN event_id % 50 ELSE who END AS who, "at" FROM happening WHERE event_type IN ('purchase', 'click')
)
SELECT event_id, p.who, "at", spell_id, begins, ends
FROM point p LEFT JOIN spell s ON p.who = s.who AND begins <= "at" AND (ends IS NULL OR "at" < ends)"""


def d_snapshot_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders before and after prices rose, orders went, came and were written twice."""
    before = orders(spark, sf_dir)
    price = F.when(F.expr("priority = '2-HIGH' and price > 400000"), F.col("price") + 1).otherwise(F.col("price"))
    kept = before.withColumn("price", price).filter("not (priority = '5-LOW' and price < 50000)")
    came = before.filter("priority = '1-URGENT' and price < 20000").withColumn("order_key", -F.col("order_key") - 1)
    twice = before.filter("priority = '1-URGENT' and price > 450000")
    after = kept.unionByName(came).unionByName(twice)
    return snapshot_changes(before, after, "order_key", partition="priority")


D_SNAPSHOT_CHANGES = f"""
WITH {ORDERS},
kept AS (
  SELECT * REPLACE (CASE WHEN priority = '2-HIGH' AND price > 400000 THEN price + 1 ELSE price END AS price)
  FROM orders_ WHERE NOT (priority = '5-LOW' AND price < 50000)
),
after_ AS (
  FROM kept UNION ALL
  SELECT * REPLACE (-order_key - 1 AS order_key) FROM orders_ WHERE priority = '1-URGENT' AND price < 20000 UNION ALL
  FROM orders_ WHERE priority = '1-URGENT' AND price > 450000
),
old AS (SELECT order_key, list(o ORDER BY o) AS r FROM orders_ o GROUP BY order_key),
new AS (SELECT order_key, list(a ORDER BY a) AS r FROM after_ a GROUP BY order_key)
SELECT unnest(coalesce(new.r, old.r)[-1]), CASE WHEN old.r IS NULL THEN 'INSERT' WHEN new.r IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS operation,
       coalesce(len(old.r), 0)::BIGINT AS n_before, coalesce(len(new.r), 0)::BIGINT AS n_after
FROM old FULL JOIN new ON old.order_key = new.order_key WHERE old.r IS DISTINCT FROM new.r"""


def w_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of users, and of the shared account, that end after two hours without an event."""
    value = F.sum("value").cast("decimal(18,2)").cast("double").alias("value")
    return session_summary(happenings(spark, sf_dir), "who", "at", F.expr("interval 2 hours"), value)


W_SESSIONS = f"""
WITH {HAPPENINGS},
marked AS (
  SELECT *, coalesce(lag("at") OVER w + INTERVAL 2 HOURS < "at", true) AS begins FROM happening
  WHERE who IS NOT NULL AND "at" IS NOT NULL WINDOW w AS (PARTITION BY who ORDER BY "at")
),
numbered AS (
  SELECT *, count(*) FILTER (begins) OVER (PARTITION BY who ORDER BY "at" RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n FROM marked
)
SELECT who, n AS session_number, min("at") AS session_start, max("at") AS session_end, count(*) AS events, CAST(sum(value) AS DOUBLE) AS value
FROM numbered GROUP BY who, n"""


def w_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event with the number of events and the purchases of its user in the last day."""
    sums = {"events": F.lit(1).cast("long"), "spent": F.when(F.expr("event_type = 'purchase'"), F.col("value"))}
    found = rolling_sums(happenings(spark, sf_dir), "who", "at", F.expr("interval 1 day"), sums)
    return found.select("event_id", "who", "at", "events", F.col("spent").cast("decimal(18,2)").cast("double").alias("spent"))


W_ROLLING = f"""
WITH {HAPPENINGS}
SELECT event_id, who, "at", CASE WHEN who IS NOT NULL AND "at" IS NOT NULL THEN count(*) OVER w END AS events,
       CASE WHEN who IS NOT NULL AND "at" IS NOT NULL THEN CAST(sum(CASE WHEN event_type = 'purchase' THEN value END) OVER w AS DOUBLE) END AS spent
FROM happening
WINDOW w AS (PARTITION BY who ORDER BY "at" RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW)"""

QUERIES = {
    query.__name__: query
    for query in (
        j_asof_shipment,
        j_asof_view,
        j_version_at,
        j_interval_spells,
        d_snapshot_changes,
        w_sessions,
        w_rolling,
    )
}

ORACLES = {
    "j_asof_shipment": J_ASOF_SHIPMENT,
    "j_asof_view": J_ASOF_VIEW,
    "j_version_at": J_VERSION_AT,
    "j_interval_spells": J_INTERVAL_SPELLS,
    "d_snapshot_changes": D_SNAPSHOT_CHANGES,
    "w_sessions": W_SESSIONS,
    "w_rolling": W_ROLLING,
}
