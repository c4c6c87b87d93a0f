"""Sources, sinks, incremental merges, versions and streams over the bound tables."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import functions as F

from checks.registry import clicks, query, shop
from checks.sqltext import big, dbl
from merchlens.functions.scalar import sum_exact
from merchlens.operators import facts, quality, search
from merchlens.operators.sessions import sessionise
from merchlens.session import work_dir
from merchlens.sources import datasets, incremental, operational, sinks
from merchlens.sources.bindings import CLICK_STAGES, SCHEMAS, event_columns, table
from merchlens.streaming import changes

_EVENTS_SQL = f"SELECT 'ACTION' AS cdc_action, * REPLACE ({dbl('cart_value')} AS cart_value, {big('step_number')} AS step_number) FROM stg_events"


@query("src_1_resolve_dataset", "SELECT user_id, signup_date, country FROM stg_users")
def resolve(spark, sf_dir):
    """Users written as CSV only: parquet is tried first, the typed CSV answers."""
    folder = work_dir(spark, "csv")
    shop(spark, sf_dir).stg_users.select("user_id", "signup_date", "country").write.option("header", True).csv(
        f"{folder}/users.csv"
    )
    return datasets.resolve(spark, f"{folder}/users", "user_id bigint, signup_date date, country string")


_LINE = "CASE WHEN user_id % 7 = 0 THEN user_id || ',soon,' || country WHEN user_id % 11 = 0 THEN user_id || ',' || CAST(signup_date AS VARCHAR) WHEN user_id % 13 = 0 THEN user_id || ',' || CAST(signup_date AS VARCHAR) || ',' || country || ',more' ELSE user_id || ',' || CAST(signup_date AS VARCHAR) || ',' || country END"


@query(
    "src_1_rejects",
    f"""
WITH l AS (SELECT *, user_id % 7 = 0 OR user_id % 11 = 0 OR user_id % 13 = 0 AS broken, {_LINE} AS line FROM stg_users)
SELECT CASE WHEN NOT broken THEN user_id END AS user_id, CASE WHEN NOT broken THEN signup_date END AS signup_date,
       CASE WHEN NOT broken THEN country END AS country, CASE WHEN broken THEN line END AS record FROM l""",
)
def rejects(spark, sf_dir):
    """A CSV with wrong dates, missing and surplus cells: the good rows typed, every broken line whole."""
    users = shop(spark, sf_dir).stg_users
    lines = users.select(F.expr(_LINE.replace("VARCHAR", "STRING")).alias("value"))
    path = work_dir(spark, "broken")
    lines.write.text(path)
    good, broken = datasets.read_checked(spark, path, "user_id bigint, signup_date date, country string", header=False)
    return good.withColumn("record", F.lit(None).cast("string")).unionByName(broken.select("record"), allowMissingColumns=True)


@query("src_2_views", "SELECT count(*) AS n, count(DISTINCT user_id) AS users FROM raw_orders", "orders")
def views(spark, sf_dir):
    datasets.register(shop(spark, sf_dir).raw)
    return spark.sql("SELECT count(*) AS n, count(DISTINCT user_id) AS users FROM raw_orders")


@query("src_3_catalog", f"SELECT product_id, category, {dbl('price')} AS price FROM stg_products")
def catalog(spark, sf_dir):
    store = datasets.Catalog(work_dir(spark, "catalog"))
    store.save("dim_products", shop(spark, sf_dir).stg_products.select("product_id", "category", "price"))
    return store.load(spark, "dim_products")


_OPERATIONAL = """
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(NULL AS VARCHAR) AS session_id, 'OP-USR-' || o_custkey AS user_id,
       strftime(o_orderdate, '%Y-%m-%d') AS order_date, o_orderdate AS order_timestamp, CAST(NULL AS DOUBLE) AS subtotal,
       CAST(NULL AS DOUBLE) AS tax_amount, CAST(NULL AS DOUBLE) AS shipping_fee, CAST(NULL AS DOUBLE) AS discount_amount,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS total_amount, o_orderpriority AS payment_method, lower(o_orderstatus) AS status,
       CAST(NULL AS VARCHAR) AS ab_variant, 'operational_backend' AS data_source FROM orders"""


def _operational_rows(spark, sf_dir):
    """The order table in the shape of the operational database."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_number"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("total_amount"),
        F.col("o_orderpriority").alias("payment_method"),
        F.col("o_orderdate").alias("created_at"),
    )


@query("src_5_operational_orders", _OPERATIONAL)
def operational_orders(spark, sf_dir):
    return operational.normalise_orders(_operational_rows(spark, sf_dir))


@query(
    "src_5_operational_api_orders",
    _OPERATIONAL.replace("CAST(o_orderkey AS VARCHAR) AS order_id", "'OP-' || o_orderkey AS order_id").replace(
        "lower(o_orderstatus)", "o_orderstatus"
    ),
)
def operational_api_orders(spark, sf_dir):
    return operational.normalise_orders(_operational_rows(spark, sf_dir), prefix_orders=True, keep_status_case=True)


@query(
    "src_6_presence",
    "\nUNION ALL\n".join(
        f"SELECT '{t}' AS \"table\", count(*) AS rows, count(*) > 0 AS present FROM raw_{t}"
        for t in ("users", "products", "sessions", "events", "orders", "order_items")
    ),
)
def presence(spark, sf_dir):
    return datasets.presence(dict(shop(spark, sf_dir).raw.items()))


@query("snk_1_export", f"SELECT product_id, product_name, {dbl('price')} AS price, {big('total_units_sold')} AS total_units_sold FROM dim_products")
def export(spark, sf_dir):
    folder = work_dir(spark, "export")
    columns = ["product_id", "product_name", "price", "total_units_sold"]
    sinks.export(shop(spark, sf_dir).dim_products.select(*columns), folder, "dim_products")
    schema = "product_id bigint, product_name string, price double, total_units_sold bigint"
    return spark.read.option("header", True).schema(schema).csv(f"{folder}/dim_products.csv")


@query(
    "snk_2_partitioned_fact",
    f"SELECT order_date, count(*) AS orders, {dbl('sum(total_amount)')} AS revenue FROM fct_orders GROUP BY 1",
    "click",
)
def partitioned_fact(spark, sf_dir):
    path = work_dir(spark, "fct-orders")
    sinks.write_mart("fct_orders", clicks(spark, sf_dir).fct_orders, path)
    stored = spark.read.parquet(path)
    return stored.groupBy("order_date").agg(F.count(F.lit(1)).alias("orders"), F.sum("total_amount").alias("revenue"))


@query(
    "snk_2_monthly_fact",
    f"SELECT activity_month, count(*) AS users, {dbl('sum(monthly_revenue)')} AS revenue FROM fct_user_retention GROUP BY 1",
)
def monthly_fact(spark, sf_dir):
    path = work_dir(spark, "fct-retention")
    sinks.write_mart("fct_user_retention", shop(spark, sf_dir).fct_user_retention, path)
    stored = spark.read.parquet(path)
    return stored.groupBy("activity_month").agg(F.count(F.lit(1)).alias("users"), F.sum("monthly_revenue").alias("revenue"))


@query("snk_3_clustered_dimension", f"SELECT user_id, customer_segment, country, {dbl('lifetime_revenue')} AS lifetime_revenue FROM dim_users")
def clustered(spark, sf_dir):
    path = work_dir(spark, "dim-users")
    sinks.write_mart("dim_users", shop(spark, sf_dir).dim_users, path)
    return spark.read.parquet(path).select("user_id", "customer_segment", "country", "lifetime_revenue")


@query(
    "snk_3_files_read",
    "SELECT count(*) FILTER (ab_variant = 'control') AS rows_kept, TRUE AS fewer_than_sorted FROM fct_funnel",
    "click",
)
def files_read(spark, sf_dir):
    """A filter on the last of three cluster columns reads fewer of 64 files than in a table sorted by them in turn."""
    funnel = clicks(spark, sf_dir).fct_funnel.select("session_id", "total_events_count", "session_start", "ab_variant")
    cluster, folder = ["session_start", "total_events_count", "ab_variant"], work_dir(spark, "clustered")
    sinks.write_dimension(funnel, f"{folder}/curve", cluster, files=64)
    funnel.repartitionByRange(64, *cluster).sortWithinPartitions(*cluster).write.parquet(f"{folder}/sorted")
    read = {name: sinks.files_to_read(spark.read.parquet(f"{folder}/{name}"), "ab_variant", "control").first() for name in ("curve", "sorted")}
    kept = spark.read.parquet(f"{folder}/curve").where(F.col("ab_variant") == "control").agg(F.count(F.lit(1)).alias("rows_kept"))
    return kept.withColumn("fewer_than_sorted", F.lit(read["curve"].files_read < read["sorted"].files_read))


@query(
    "snk_4_json_report",
    """
SELECT '{"customer_segment":"' || customer_segment || '","users":' || count(*) || ',"orders":' || sum(lifetime_orders) || '}' AS value
FROM dim_users GROUP BY customer_segment""",
)
def json_report(spark, sf_dir):
    rows = shop(spark, sf_dir).dim_users.groupBy("customer_segment").agg(
        F.count(F.lit(1)).alias("users"), F.sum("lifetime_orders").alias("orders")
    )
    path = work_dir(spark, "report")
    sinks.write_report(rows, path)
    return spark.read.text(path)


@query(
    "snk_5_parity",
    """
SELECT count(*) AS left_rows, count(*) AS right_rows, CAST(0 AS BIGINT) AS left_only, CAST(0 AS BIGINT) AS right_only,
       CAST(0 AS BIGINT) AS user_id_differs, CAST(0 AS BIGINT) AS order_timestamp_differs, CAST(0 AS BIGINT) AS total_amount_differs,
       CAST(0 AS BIGINT) AS status_differs FROM stg_orders""",
)
def parity(spark, sf_dir):
    folder = work_dir(spark, "parity")
    columns = ["order_id", "user_id", "order_timestamp", "total_amount", "status"]
    sinks.export(shop(spark, sf_dir).stg_orders.select(*columns), folder, "orders")
    schema = "order_id bigint, user_id bigint, order_timestamp timestamp_ntz, total_amount double, status string"
    stored = spark.read.parquet(f"{folder}/orders.parquet")
    text = spark.read.option("header", True).schema(schema).csv(f"{folder}/orders.csv")
    return sinks.parity(stored, text, "order_id")


@query(
    "snk_5_multiset_difference",
    """
(SELECT payment_method, status, 'left' AS only_in FROM (SELECT payment_method, status FROM stg_orders EXCEPT ALL SELECT payment_method, 'completed' FROM stg_orders))
UNION ALL (SELECT payment_method, status, 'right' FROM (SELECT payment_method, 'completed' AS status FROM stg_orders EXCEPT ALL SELECT payment_method, status FROM stg_orders))""",
)
def multiset(spark, sf_dir):
    orders = shop(spark, sf_dir).stg_orders.select("payment_method", "status")
    return sinks.multiset_difference(orders, orders.withColumn("status", F.lit("completed")))


_MERGED = f"SELECT order_id, user_id, order_date, status, {dbl('total_amount')} AS total_amount, user_order_sequence FROM fct_orders"
_FACT_COLUMNS = ["order_id", "user_id", "order_date", "order_timestamp", "status", "total_amount", "user_order_sequence"]


def _incremental_orders(spark, sf_dir, batches):
    """Run the order fact incrementally; the first run sees orders up to a day only."""
    path = work_dir(spark, "incremental")
    world = shop(spark, sf_dir)
    for until in batches:

        def build(since, until=until):
            seen = world.stg_orders if until is None else world.stg_orders.where(F.col("order_date") <= F.lit(until))
            numbered = facts.sequenced_orders(seen)
            kept = numbered if since is None else numbered.where(F.col("order_timestamp") >= F.lit(since))
            # Few orders per day here: partition by month.
            return kept.select(*_FACT_COLUMNS, F.trunc("order_date", "MM").alias("order_month"))

        incremental.incremental_build(
            spark, path, build, ["order_id"], "order_month", "order_timestamp", days=3, fixed_partition=True
        )
    return spark.read.parquet(path).drop("order_timestamp", "order_month")


@query("inc_1_incremental_orders", _MERGED)
def incremental_orders(spark, sf_dir):
    """A build that stops three days before the end, then the look-back run that completes it."""
    last = shop(spark, sf_dir).stg_orders.agg(F.max("order_date")).first()[0]
    return _incremental_orders(spark, sf_dir, [last - timedelta(days=3), None])


@query("inc_3_same_batch_twice", _MERGED)
def same_batch_twice(spark, sf_dir):
    return _incremental_orders(spark, sf_dir, [None, None])


@query(
    "inc_1_incremental_funnel",
    f"SELECT session_id, session_date, {big('funnel_stage_order')} AS funnel_stage_order, total_events_count, count(*) AS rows FROM fct_funnel GROUP BY ALL",
    "click",
)
def incremental_funnel(spark, sf_dir):
    """Sessions at session grain (orders left out), built twice with the look-back."""
    path = work_dir(spark, "funnel")
    world = clicks(spark, sf_dir)

    def build(since):
        flags = world.int_session_funnel_events.select("session_id", "funnel_stage_order", "total_events_count")
        sessions = world.stg_sessions.select("session_id", "session_date", "session_start")
        recent = sessions if since is None else sessions.where(F.col("session_start") >= F.lit(since))
        return recent.join(flags, "session_id", "left")

    for _ in range(2):
        incremental.incremental_build(spark, path, build, ["session_id"], "session_date", "session_start")
    orders = facts.completed_by_session(world.stg_orders).groupBy("session_id").agg(F.count(F.lit(1)).alias("rows"))
    stored = spark.read.parquet(path).drop("session_start").join(orders, "session_id", "left")
    return stored.withColumn("rows", F.coalesce("rows", F.lit(1)))


@query(
    "inc_4_schema_sync",
    f"""
SELECT order_id, order_date, CASE WHEN status = 'completed' THEN {dbl('total_amount')} END AS total_amount,
       CASE WHEN status <> 'completed' THEN payment_method END AS payment_method FROM stg_orders""",
)
def schema_sync(spark, sf_dir):
    """The second batch lacks a column and brings a new one."""
    orders = shop(spark, sf_dir).stg_orders.withColumn("order_month", F.trunc("order_date", "MM"))
    path = work_dir(spark, "schema")
    kept = ["order_id", "order_date", "order_month"]
    done = orders.where(F.col("status") == "completed").select(*kept, "total_amount")
    rest = orders.where(F.col("status") != "completed").select(*kept, "payment_method")
    incremental.merge_into(spark, path, done, ["order_id"], "order_month")
    incremental.merge_into(spark, path, rest, ["order_id"], "order_month")
    return incremental.stored(spark, path).drop("order_month")


@query(
    "inc_5_partitions_searched",
    """
WITH m AS (SELECT date_trunc('month', order_date) AS month, min(order_id) AS low, max(order_id) AS high FROM stg_orders GROUP BY 1),
d AS (SELECT order_id FROM stg_orders WHERE order_date >= (SELECT max(order_date) FROM stg_orders) - INTERVAL 2 DAY)
SELECT count(*) AS partitions, count(*) FILTER (low <= (SELECT max(order_id) FROM d) AND high >= (SELECT min(order_id) FROM d)) AS within_hull,
       (SELECT count(*) FROM m WHERE EXISTS (SELECT 1 FROM d WHERE order_id BETWEEN low AND high)) AS searched FROM m""",
)
def partitions_searched(spark, sf_dir):
    """How many monthly partitions a merge of the last three days' orders looks for older rows in."""
    orders = shop(spark, sf_dir).stg_orders.select("order_id", "order_date", F.trunc("order_date", "MM").alias("order_month"))
    path = work_dir(spark, "ranges")
    incremental.merge_into(spark, path, orders, ["order_id"], "order_month")
    last = orders.agg(F.max("order_date")).first()[0]
    delta = orders.where(F.col("order_date") >= F.lit(last - timedelta(days=2)))
    ranges = incremental.KeyRanges(spark, path, ["order_id"], orders.schema["order_month"])
    ranges.SLICES = 100_000  # a slice per key: no range is met by chance
    hull = delta.agg(F.min("order_id").alias("least"), F.max("order_id").alias("most"))
    within = ranges.read().join(hull, (F.col("low.order_id") <= F.col("most")) & (F.col("high.order_id") >= F.col("least")))
    return ranges.read().agg(F.count(F.lit(1)).alias("partitions")).withColumns(
        {
            "within_hull": within.agg(F.count(F.lit(1))).scalar(),
            "searched": F.lit(len(ranges.meeting(delta))).cast("bigint"),
        }
    )


@query(
    "inc_2_latest_in_batch",
    f"SELECT user_id, max(order_id) AS order_id FROM (SELECT *, rank() OVER (PARTITION BY user_id ORDER BY order_timestamp DESC) AS r FROM stg_orders) WHERE r = 1 GROUP BY 1",
)
def latest_in_batch(spark, sf_dir):
    orders = shop(spark, sf_dir).stg_orders.select("user_id", "order_id", "order_timestamp")
    return incremental.latest_rows(orders, ["user_id"], ["order_timestamp", "order_id"]).drop("order_timestamp")


@query(
    "snp_1_corrupt_and_restore",
    f"""
WITH a AS (SELECT count(*) AS n, {dbl('sum(total_amount)')} AS t FROM stg_orders),
c AS (SELECT {dbl("sum(CASE WHEN order_date >= DATE '1999-01-01' THEN 0 ELSE total_amount END)")} AS t FROM stg_orders)
SELECT n AS before_rows, a.t AS before_total, round(a.t / n, 2) AS before_mean, n AS after_rows, a.t AS after_total, round(a.t / n, 2) AS after_mean,
       TRUE AS restored, c.t AS corrupted_total FROM a, c""",
)
def corrupt_and_restore(spark, sf_dir):
    """Snapshot, a bad update from a date on, audit, restore, audit again."""
    store = incremental.VersionedTable(spark, work_dir(spark, "versions"))
    columns = ["order_id", "order_date", "total_amount", "subtotal", "tax_amount", "shipping_fee"]
    good = store.write(shop(spark, sf_dir).stg_orders.select(*columns))
    baseline = quality.audit(store.read())
    amounts = incremental.zero_amounts(["total_amount", "subtotal", "tax_amount", "shipping_fee"])
    bad = store.update(F.col("order_date") >= F.lit(date(1999, 1, 1)), amounts)
    corrupted = quality.audit(store.read(bad)).select("total").scalar()
    store.restore(good)
    return incremental.same_totals(baseline, quality.audit(store.read())).withColumn("corrupted_total", corrupted)


def _raw_stream(spark, sf_dir):
    return event_columns(changes.change_stream(spark, sf_dir, SCHEMAS["events"], "events.parquet"))


@query("str_1_change_stream", _EVENTS_SQL.replace("ACTION", "INSERT"), "click")
def change_stream(spark, sf_dir):
    """The whole event table through the stream into the staged change table."""
    folder = work_dir(spark, "cdc")
    changes.finish(changes.upsert_stream(_raw_stream(spark, sf_dir), f"{folder}/table", f"{folder}/checkpoint"))
    return spark.read.parquet(f"{folder}/table").drop("ingested_at")


@query("str_2_backfill", _EVENTS_SQL.replace("ACTION", "BACKFILL"), "click")
def backfill(spark, sf_dir):
    path = work_dir(spark, "backfill")
    changes.backfill(clicks(spark, sf_dir).raw.events, path)
    return spark.read.parquet(path).drop("ingested_at")


@query("str_3_upsert", _EVENTS_SQL.replace("ACTION", "INSERT"), "click")
def upsert(spark, sf_dir):
    """Backfill first, then the stream brings every event again: all rows are updated."""
    folder = work_dir(spark, "upsert")
    changes.backfill(clicks(spark, sf_dir).raw.events, f"{folder}/table")
    changes.finish(changes.upsert_stream(_raw_stream(spark, sf_dir), f"{folder}/table", f"{folder}/checkpoint"))
    return spark.read.parquet(f"{folder}/table").drop("ingested_at")


@query(
    "str_4_stream_has_data",
    "SELECT count(*) AS landed, TRUE AS had_data, FALSE AS has_data_after FROM stg_events",
    "click",
)
def stream_has_data(spark, sf_dir):
    """Rows read by a first run and by a second one with nothing new."""
    folder = work_dir(spark, "offsets")
    runs = [
        changes.finish(changes.upsert_stream(_raw_stream(spark, sf_dir), f"{folder}/table", f"{folder}/checkpoint"))
        for _ in range(2)
    ]
    return spark.read.parquet(f"{folder}/table").agg(F.count(F.lit(1)).alias("landed")).withColumns(
        {"had_data": F.lit(runs[0] > 0), "has_data_after": F.lit(runs[1] > 0)}
    )


@query(
    "str_6_running_funnel",
    f"""
SELECT session_id, user_id, count(*) AS total_events_count,
       {', '.join(f"count(*) FILTER (event_type = '{s.name}') AS {s.name}_events" for s in CLICK_STAGES)}, {big('max(step_number)')} AS furthest_step_reached,
       {', '.join(f"min(event_timestamp) FILTER (event_type = '{s.name}') AS first_{s.name}_at" for s in CLICK_STAGES)}, {dbl('max(cart_value)')} AS final_cart_value
FROM stg_events GROUP BY 1, 2""",
    "click",
)
def running_funnel(spark, sf_dir):
    """Three batches, each with sessions of all others, the earliest events in the last one."""
    from merchlens.operators.staging import stg_events

    folder = work_dir(spark, "running")
    for events in _arriving(spark, sf_dir, f"{folder}/in"):
        changes.finish(changes.funnel_stream(stg_events(events), f"{folder}/runs", f"{folder}/checkpoint", CLICK_STAGES))
    names = [s.name for s in CLICK_STAGES]
    return changes.read_funnel(spark, f"{folder}/runs", CLICK_STAGES).select(
        "session_id",
        "user_id",
        "total_events_count",
        *(f"{n}_events" for n in names),
        "furthest_step_reached",
        *(f"first_{n}_at" for n in names),
        "final_cart_value",
    )


def _arriving(spark, sf_dir, folder):
    """The stream over all events, once after each of three arrivals: odd ids, even ids, and last the first half of January."""
    events = table(spark, sf_dir, "events")
    late = F.col("ts") < F.lit(date(2024, 1, 16)).cast("timestamp_ntz")
    odd = F.col("event_id") % 2 == 1
    for part in (odd & ~late, ~odd & ~late, F.coalesce(late, F.lit(True))):
        events.where(part).write.mode("append").parquet(folder)
        yield event_columns(changes.change_stream(spark, folder, SCHEMAS["events"]))


_GAP = """
g AS (SELECT *, lag(event_timestamp) OVER w AS before FROM stg_events WINDOW w AS (PARTITION BY user_id ORDER BY event_timestamp, event_id)),
n AS (SELECT *, sum(CAST(before IS NULL OR event_timestamp - before > INTERVAL 30 MINUTE AS INT)) OVER (PARTITION BY user_id ORDER BY event_timestamp, event_id) AS s FROM g)"""


@query("str_7_sessionise", f"WITH {_GAP} SELECT event_id, user_id, event_timestamp, {big('s')} AS session_number FROM n", "click")
def sessionise_events(spark, sf_dir):
    events = clicks(spark, sf_dir).stg_events.select("event_id", "user_id", "event_timestamp")
    return sessionise(events)


_WINDOWS = f"WITH {_GAP} SELECT user_id, min(event_timestamp) AS session_start, max(event_timestamp) AS session_end, count(*) AS events FROM n GROUP BY user_id, s"


@query("str_7_session_windows", _WINDOWS, "click")
def session_windows(spark, sf_dir):
    return changes.session_windows(clicks(spark, sf_dir).stg_events)


@query("str_7_streamed_session_windows", _WINDOWS, "click")
def streamed_session_windows(spark, sf_dir):
    """The same sessions from three batches; the second bridges sessions of the first, the last comes weeks late."""
    from merchlens.operators.staging import stg_events

    folder = work_dir(spark, "windows")
    for events in _arriving(spark, sf_dir, f"{folder}/in"):
        changes.finish(changes.session_stream(stg_events(events), f"{folder}/runs", f"{folder}/checkpoint"))
    return changes.read_sessions(spark, f"{folder}/runs")


@query(
    "flt_5_product_search",
    f"""
SELECT product_id, product_name, category, {dbl('price')} AS price FROM stg_products
WHERE lower(category) = 'economy' AND price BETWEEN 900 AND 1200 AND lower(product_name) LIKE '%ring%'""",
)
def product_search(spark, sf_dir):
    found = search.search_products(shop(spark, sf_dir).stg_products, " Economy ", 900, 1200, " RING ")
    return found.select("product_id", "product_name", "category", "price")


@query(
    "srt_3_product_page",
    f"""
SELECT product_id, product_name, {dbl('price')} AS price FROM stg_products WHERE price >= 900 ORDER BY price DESC, product_id LIMIT 20 OFFSET 40""",
)
def product_page(spark, sf_dir):
    found = search.search_products(shop(spark, sf_dir).stg_products, min_price=900)
    return search.page(found, [F.desc("price"), "product_id"], 2, 20).select("product_id", "product_name", "price")


@query(
    "flt_6_orders_of_user",
    f"""
WITH best AS (SELECT user_id FROM stg_orders GROUP BY 1 ORDER BY sum(total_amount) DESC, user_id LIMIT 1)
SELECT order_id, order_timestamp, {dbl('total_amount')} AS total_amount FROM stg_orders
WHERE user_id = (SELECT user_id FROM best) ORDER BY order_timestamp DESC, order_id LIMIT 5""",
)
def orders_of_user(spark, sf_dir):
    """First page of the orders of the user who spent most."""
    orders = shop(spark, sf_dir).stg_orders
    spent = orders.groupBy("user_id").agg(sum_exact("total_amount").alias("spent"))
    best = spent.agg(F.max_by("user_id", F.struct("spent", -F.col("user_id")))).scalar()
    found = search.orders_of_user(orders, best, 0, 5)
    return found.select("order_id", "order_timestamp", "total_amount")
