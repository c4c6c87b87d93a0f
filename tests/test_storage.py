from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from merchlens.operators import quality, search
from merchlens.plans import reports
from merchlens.plans.publish import materialise
from merchlens.plans.warehouse import Warehouse
from merchlens.session import work_dir
from merchlens.sources import datasets, operational, sinks
from merchlens.sources.incremental import VersionedTable, incremental_build, latest_rows, merge, merge_into, same_totals, zero_amounts
from merchlens.streaming import changes
from tests.conftest import rows

ORDERS = "id string, day date, v int"


def orders(spark, *data):
    return spark.createDataFrame([(i, date(2024, 1, d), v) for i, d, v in data], ORDERS)


def stored(spark, path):
    return rows(spark.read.parquet(path).select("id", F.dayofmonth("day").alias("d"), "v"))


def test_parquet_wins_csv_answers_neither_fails(spark, folder):
    df = spark.createDataFrame([(1, "a")], "id int, name string")
    with pytest.raises(datasets.DatasetMissing):
        datasets.resolve(spark, f"{folder}/t")
    df.write.option("header", True).csv(f"{folder}/t.csv")
    assert datasets.resolve(spark, f"{folder}/t.parquet", "id int, name string").first().id == 1
    df.withColumn("name", F.lit("parquet")).write.parquet(f"{folder}/t.parquet")
    assert datasets.resolve(spark, f"{folder}/t.csv").first().name == "parquet"


def test_raw_load_views_and_presence(spark, folder, shop_tables):
    for name, df in shop_tables.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    assert datasets.missing_tables(spark, folder) == []
    raw = datasets.load_raw(spark, folder)
    assert spark.sql("SELECT count(*) FROM raw_orders").first()[0] == 5
    assert spark.sql("SELECT count(*) FROM users").first()[0] == 5
    assert all(r.present for r in datasets.presence(dict(raw.items())).collect())
    assert datasets.missing_tables(spark, folder, ["users", "nothing"]) == ["nothing"]


def test_catalog_holds_every_dataset(spark, folder, shop_tables):
    store = datasets.Catalog(folder)
    assert len(store.names()) == 17
    w = Warehouse(shop_tables, date(2024, 5, 1))
    store.save("dim_products", w.dim_products)
    assert store.load(spark, "dim_products").count() == 3
    for name, df in reports.reports(w.fct_funnel, w.fct_user_retention, w.stg_orders, w.fct_ab_test).items():
        store.save(name, df)
    assert '"total_sessions":4' in store.load(spark, "statistical_summary_report").first()[0]


def test_export_and_parity(spark, folder, shop_tables):
    w = Warehouse(shop_tables, date(2024, 5, 1))
    sinks.export(w.stg_products, folder, "products")
    text = spark.read.schema(w.stg_products.schema).option("header", True).csv(f"{folder}/products.csv")
    same = sinks.parity(spark.read.parquet(f"{folder}/products.parquet"), text, "product_id").first()
    assert same.left_rows == 3 and not any(v for k, v in same.asDict().items() if k.endswith(("only", "differs")))
    changed = text.withColumn("price", F.when(F.col("product_id") == "PRD-1", 10.02).otherwise(F.col("price")))
    assert sinks.parity(w.stg_products, changed, "product_id").first().price_differs == 1
    assert sinks.parity(w.stg_products, text.limit(2), "product_id").first().left_only == 1


def test_mart_layout(spark, folder, shop_tables):
    w = Warehouse(shop_tables, date(2024, 5, 1))
    sinks.write_mart("fct_orders", w.fct_orders, f"{folder}/fct_orders")
    again = spark.read.parquet(f"{folder}/fct_orders")
    assert again.count() == 5 and set(again.columns) == set(w.fct_orders.columns)
    plan = again.where(F.col("order_date") == date(2024, 3, 1))._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(order_date" in plan


def test_operational_orders(spark):
    df = spark.createDataFrame([("N1", 7, "SHIPPED", "12.345", "x", "2024-01-02 03:04:05")], "order_number string, user_id int, status string, subtotal string, total_amount string, created_at string")
    row = operational.normalise_orders(df).first()
    assert (row.order_id, row.user_id, row.status, row.order_date) == ("N1", "OP-USR-7", "shipped", "2024-01-02")
    assert row.subtotal == 12.35 and row.total_amount is None and row.tax_amount is None
    assert row.session_id is None and row.data_source == "operational_backend"
    api = operational.normalise_orders(df, prefix_orders=True, keep_status_case=True).first()
    assert (api.order_id, api.status) == ("OP-N1", "SHIPPED")
    assert operational.no_orders(spark).columns == operational.normalise_orders(df).columns


def test_search_ignores_blank_conditions(spark):
    df = spark.createDataFrame([("Red Lamp", "Home", 10.0, "ACTIVE"), ("Shoe", "Apparel", 50.0, "ACTIVE"), ("Old Lamp", "Home", 5.0, "GONE")], "product_name string, category string, price double, status string")
    assert search.search_products(df, " ", text="").count() == 2
    assert [r.product_name for r in search.search_products(df, "HOME", 1, 20, "lamp").collect()] == ["Red Lamp"]
    assert [r.price for r in search.page(df, ["price"], 1, 2).collect()] == [50.0]


def test_merge_keeps_the_last_duplicate(spark):
    batch = orders(spark, ("a", 1, 1), ("a", 2, 2), ("b", 1, 5))
    assert rows(latest_rows(batch, ["id"], ["day"]).select("id", "v")) == [("a", 2), ("b", 5)]
    merged = merge(orders(spark, ("b", 1, 0), ("c", 1, 9)), latest_rows(batch, ["id"], ["day"]), ["id"])
    assert rows(merged.select("id", "v")) == [("a", 2), ("b", 5), ("c", 9)]


def test_merge_into_touches_only_its_partitions(spark, folder):
    path = f"{folder}/t"
    merge_into(spark, path, orders(spark, ("a", 1, 1), ("b", 1, 2), ("c", 2, 3), ("d", 3, 4)), ["id"], "day")

    def files():
        return rows(spark.read.parquet(path).where("day = '2024-01-03'").select(F.input_file_name()))

    untouched = files()
    merge_into(spark, path, orders(spark, ("b", 1, 20), ("e", 2, 5)), ["id"], "day", ["v"])
    assert stored(spark, path) == [("a", 1, 1), ("b", 1, 20), ("c", 2, 3), ("d", 3, 4), ("e", 2, 5)]
    assert files() == untouched


def test_a_key_that_changes_partition_leaves_no_copy(spark, folder):
    path = f"{folder}/t"
    merge_into(spark, path, orders(spark, ("a", 1, 1), ("b", 2, 2), ("c", 2, 3)), ["id"], "day")
    merge_into(spark, path, orders(spark, ("a", 3, 10), ("b", 3, 20)), ["id"], "day")  # day 1 becomes empty
    assert stored(spark, path) == [("a", 3, 10), ("b", 3, 20), ("c", 2, 3)]


def test_merge_into_is_idempotent_and_takes_empty_batches(spark, folder):
    path = f"{folder}/t"
    batch = orders(spark, ("a", 1, 1), ("b", 2, 2))
    for _ in range(2):
        merge_into(spark, path, batch, ["id"], "day")
    merge_into(spark, path, batch.where("false"), ["id"], "day")
    assert stored(spark, path) == [("a", 1, 1), ("b", 2, 2)]


def test_schema_follows_the_batch(spark, folder):
    path = f"{folder}/t"
    merge_into(spark, path, orders(spark, ("a", 1, 1)), ["id"], "day")
    merge_into(spark, path, orders(spark, ("b", 1, 2)).withColumn("note", F.lit("new")), ["id"], "day")
    got = rows(spark.read.option("mergeSchema", True).parquet(path).select("id", "note"))
    assert got == [("a", None), ("b", "new")]


def test_look_back_accepts_late_rows_and_ignores_older_ones(spark, folder):
    path = f"{folder}/t"
    first = orders(spark, ("a", 1, 1), ("b", 10, 2))
    second = orders(spark, ("a", 1, 100), ("b", 10, 20), ("late", 8, 3), ("new", 11, 4))

    def build(df):
        return lambda since: df if since is None else df.where(F.col("day") >= F.lit(since))

    for df in (first, second, second):
        incremental_build(spark, path, build(df), ["id"], "day", "day", days=3)
    assert stored(spark, path) == [("a", 1, 1), ("b", 10, 20), ("late", 8, 3), ("new", 11, 4)]


def test_versions_survive_a_bad_update(spark, folder):
    store = VersionedTable(spark, f"{folder}/v")
    with pytest.raises(FileNotFoundError):
        store.read()
    df = orders(spark, ("a", 1, 10), ("b", 5, 20)).withColumnRenamed("v", "total_amount")
    good = store.write(df)
    before = quality.audit(store.read())
    bad = store.update(F.col("day") >= F.lit(date(2024, 1, 5)), zero_amounts(["total_amount"]))
    assert quality.audit(store.read()).first().total == 10 and store.current() == bad
    assert store.restore(good) == 3 and store.versions() == [1, 2, 3]
    assert same_totals(before, quality.audit(store.read())).first().restored
    assert store.merge(orders(spark, ("b", 5, 7)).withColumnRenamed("v", "total_amount"), ["id"], ["day"]) == 4
    assert quality.audit(store.read()).first().total == 17


def test_uncommitted_version_is_not_read(spark, folder):
    store = VersionedTable(spark, f"{folder}/v")
    store.write(spark.range(3))
    spark.range(9).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{folder}/v/version=2")
    assert store.current() == 1 and store.read().count() == 3


EVENTS = "event_id string, session_id string, user_id string, event_timestamp timestamp, event_name string, event_type string, step_number int, page_url string, product_id string, cart_value double"


@pytest.mark.parametrize("old, new", [(None, "x"), ("a b:c/d", "x"), ("x", None), ("007", "7"), ("7", "007"), ("x", "a b:c/d")])
def test_merge_moves_a_row_between_partitions(spark, folder, old, new):
    kind = "id int, part string, v int"
    merge_into(spark, folder, spark.createDataFrame([(1, old, 1), (2, "stay", 1)], kind), ["id"], "part")
    for _ in range(2):  # the second time it is the same batch again
        merge_into(spark, folder, spark.createDataFrame([(1, new, 2)], kind), ["id"], "part")
        got = spark.read.schema("id int, v int, part string").parquet(folder)
        assert rows(got.select("id", "part", "v")) == sorted([(1, new, 2), (2, "stay", 1)], key=repr)


def test_merge_searches_partitions_of_the_delta_keys_only(spark, folder):
    """Keys rise with the partition: a late change is looked for where its key can be, and columns are known without footers."""
    from merchlens.sources.incremental import KeyRanges, stored

    path = f"{folder}/t"
    days = [(100 * d + i, f"d{d}", i) for d in range(6) for i in range(20)]
    merge_into(spark, path, spark.createDataFrame(days, "id int, part string, v int"), ["id"], "part")
    delta = spark.createDataFrame([(305, "d5", -1, "new"), (999, "d9", 1, "new")], "id int, part string, v int, w string")
    ranges = KeyRanges(spark, path, ["id"], delta.schema["part"])
    assert ranges.meeting(delta) == {"d3"}
    merge_into(spark, path, delta, ["id"], "part")
    got = stored(spark, path)
    assert set(got.columns) == {"id", "part", "v", "w"} and got.count() == 121
    assert rows(got.where("id IN (305, 999)").select("id", "part", "v", "w")) == [(305, "d5", -1, "new"), (999, "d9", 1, "new")]
    assert ranges.meeting(delta) == {"d3", "d5", "d9"}  # a range only grows
    # A table without notes is read once and has them then.
    spark.createDataFrame(days, "id int, part string, v int").write.partitionBy("part").parquet(f"{folder}/old")
    merge_into(spark, f"{folder}/old", delta.drop("w"), ["id"], "part")
    assert stored(spark, f"{folder}/old").where("id = 305").count() == 1
    assert KeyRanges(spark, f"{folder}/old", ["id"], delta.schema["part"]).read().count() == 7


def test_latest_rows_do_not_depend_on_the_order_of_arrival(spark):
    from merchlens.sources.incremental import latest_rows

    data = [(1, 5, v) for v in range(50)]
    for n in (1, 7):
        df = spark.createDataFrame(data[n:] + data[:n], "k int, at int, v int").repartition(n)
        assert rows(latest_rows(df, ["k"], ["at"])) == [(1, 5, 49)]


def test_parity_pairs_repeated_keys(spark):
    from merchlens.sources.sinks import parity

    left = spark.createDataFrame([(1, 1.0), (1, 2.0), (1, 3.0), (2, 1.0)], "k int, v double")
    right = spark.createDataFrame([(1, 1.0), (1, 2.5), (3, 1.0)], "k int, v double")
    row = parity(left, right, "k").first()
    assert (row.left_rows, row.right_rows, row.left_only, row.right_only, row.v_differs) == (4, 3, 2, 1, 1)


def test_missing_money_is_null_or_given(spark):
    from merchlens.sources.operational import MONEY_COLUMNS, normalise_orders

    order = spark.createDataFrame([("1", "x")], f"order_id string, {MONEY_COLUMNS[0]} string")
    assert normalise_orders(order).first()[MONEY_COLUMNS[0]] is None
    assert normalise_orders(order, missing_money=0.0).first()[MONEY_COLUMNS[0]] == 0.0


def test_merge_without_order_keeps_the_largest_row(spark, folder):
    delta = spark.createDataFrame([(1, "a", 1), (1, "a", 3), (1, "a", 2)], "id int, part string, v int")
    merge_into(spark, folder, delta, ["id"], "part")
    assert rows(spark.read.parquet(folder).select("v")) == [(3,)]


def arrivals(spark, *data):
    made = [(e, "S1", "U1", at, k.upper(), f" {k} ", step, " /p ", " ", None) for e, at, k, step in data]
    return spark.createDataFrame(made, EVENTS)


def test_change_stream_lands_then_is_empty_then_updates(spark, folder):
    source, table, checkpoint = f"{folder}/in", f"{folder}/table", f"{folder}/cp"
    batch = arrivals(spark, *[(f"E{i}", datetime(2024, 1, 1, i), "purchase", 6) for i in range(5)])
    batch.write.mode("append").parquet(source)

    def run():
        return changes.finish(changes.upsert_stream(changes.change_stream(spark, source, EVENTS), table, checkpoint))

    assert run() == 5 and run() == 0
    assert spark.read.parquet(table).count() == 5
    # one late row, one update of a landed row
    arrivals(spark, ("OLD", datetime(2020, 1, 1), "purchase", 6), ("E1", datetime(2024, 1, 1, 1), "add_to_cart", 3)).write.mode("append").parquet(source)
    assert run() == 2
    got = {r.event_id: r for r in spark.read.parquet(table).collect()}
    assert len(got) == 6 and got["E1"].event_type == "add_to_cart" and got["E1"].cdc_action == "INSERT"
    assert got["OLD"].product_id is None and got["OLD"].cart_value == 0


def test_backfill_then_stream_overwrites_action(spark, folder):
    table = f"{folder}/table"
    batch = arrivals(spark, ("E1", datetime(2024, 1, 1), "purchase", 6))
    changes.backfill(batch, table)
    assert spark.read.parquet(table).first().cdc_action == "BACKFILL"
    batch.write.parquet(f"{folder}/in")
    changes.finish(changes.upsert_stream(changes.change_stream(spark, f"{folder}/in", EVENTS), table, f"{folder}/cp"))
    assert rows(spark.read.parquet(table).select("event_id", "cdc_action")) == [("E1", "INSERT")]


def test_only_insert_actions_are_taken(spark):
    df = spark.createDataFrame([(1, "INSERT"), (2, "DELETE")], "id int, cdc_action string")
    assert rows(changes.inserts(df).select("id")) == [(1,)]
    assert changes.inserts(df.select("id")).count() == 2


def three_arrivals(spark, folder):
    """Three files, one a batch: a session over midnight whose oldest event comes last, months late."""
    source = f"{folder}/in"
    batches = [
        [("E1", datetime(2024, 1, 1, 23, 50), "landing_page", 1), ("E2", datetime(2024, 1, 2, 0, 10), "product_view", 2)],
        [("E3", datetime(2024, 3, 1, 3), "purchase", 6)],
        [("E0", datetime(2024, 1, 1, 23, 25), "landing_page", 1), ("E4", datetime(2024, 1, 2, 0, 35), "checkout_started", 4)],
    ]
    for batch in batches:
        arrivals(spark, *batch).coalesce(1).write.mode("append").parquet(source)
    return source


def test_running_funnel_over_batches_equals_one_pass(spark, folder):
    from merchlens.operators.sessions import session_funnel
    from merchlens.operators.staging import stg_events

    source = three_arrivals(spark, folder)
    stream = stg_events(changes.change_stream(spark, source, EVENTS, files_per_batch=1))
    assert changes.finish(changes.funnel_stream(stream, f"{folder}/t", f"{folder}/cp")) == 5
    got = changes.read_funnel(spark, f"{folder}/t")
    once = session_funnel(stg_events(spark.read.schema(EVENTS).parquet(source)))
    assert got.count() == 1 and rows(got.select(*once.columns)) == rows(once)


def test_streamed_sessions_equal_one_pass(spark, folder):
    from merchlens.operators.staging import stg_events

    source = three_arrivals(spark, folder)
    stream = stg_events(changes.change_stream(spark, source, EVENTS, files_per_batch=1))
    changes.finish(changes.session_stream(stream, f"{folder}/t", f"{folder}/cp"))
    got = changes.read_sessions(spark, f"{folder}/t")
    once = changes.session_windows(stg_events(spark.read.schema(EVENTS).parquet(source)))
    assert rows(got) == rows(once) and sorted(r.events for r in got.collect()) == [1, 4]


def test_runs_follow_the_batch_and_take_no_batch_twice(spark, folder):
    """Nine batches leave few runs; a batch writes its own rows; replayed batches and left-over runs change nothing."""
    from merchlens.streaming.runs import Runs

    def merge(df):
        return df.groupBy("k").agg(F.sum("n").alias("n"))

    runs = Runs(spark, folder, merge, ["k"], fan_in=3)
    for batch in range(9):
        for _ in range(2):
            runs.add(batch, spark.range(batch * 10, batch * 10 + 20).select(F.col("id").alias("k"), F.lit(1).cast("bigint").alias("n")))
        if batch == 7:
            assert runs.runs() == [(1, 0, 2), (1, 3, 5), (0, 6, 6), (0, 7, 7)]
            assert spark.read.parquet(f"{folder}/run-0-7-7").count() == 20
    assert runs.runs() == [(2, 0, 8)]
    spark.range(3).select(F.col("id").alias("k"), F.lit(5).cast("bigint").alias("n")).write.parquet(f"{folder}/run-1-0-2")
    got = {r.k: r.n for r in runs.read().collect()}
    assert got == {k: 1 if k < 10 or k >= 90 else 2 for k in range(100)}


def test_sessions_of_a_hot_user_are_few_rows(spark):
    """Spans at the very gap join, later ones do not; a slot of many events is one row before the shuffle."""
    at = [datetime(2024, 1, 1, 0, 0), datetime(2024, 1, 1, 0, 30), datetime(2024, 1, 1, 1, 0, 1), datetime(2024, 1, 1, 1, 20)]
    events = spark.createDataFrame([("U", t) for t in at] + [("V", at[0])] * 1000 + [(None, at[1])], "user_id string, event_timestamp timestamp_ntz")
    got = rows(changes.session_windows(events).select("user_id", "session_start", "session_end", "events"))
    assert got == sorted([("U", at[0], at[1], 2), ("U", at[2], at[3], 2), ("V", at[0], at[0], 1000), (None, at[1], at[1], 1)], key=repr)


def test_gate(spark, shop_tables):
    w = Warehouse(shop_tables, date(2024, 5, 1))
    tables = {m: w[m] for m in ("stg_users", "stg_sessions", "stg_orders")}
    checks = quality.declared_checks(tables)
    results = quality.run_checks(tables, checks)
    got = {(r.table, r.column, r.kind): r.failures for r in results.collect()}
    assert got[("stg_sessions", "user_id", "relationships")] == 1  # USR-9
    assert got[("stg_orders", "session_id", "not_null")] == 1
    assert got[("stg_orders", "session_id", "relationships")] == 0  # a null key is no orphan
    with pytest.raises(quality.GateTripped) as tripped:
        quality.gate(results)
    assert len(tripped.value.incidents) == 2
    fixed = tables | {
        "stg_sessions": w.stg_sessions.where("user_id <> 'USR-9'"),
        "stg_orders": w.stg_orders.where("session_id IS NOT NULL"),
    }
    quality.gate(quality.run_checks(fixed, checks))


def test_missing_column_counts_as_one_failure(spark):
    df = spark.range(2)
    result = quality.run_checks({"t": df}, [quality.Check("t", "nope", "not_null"), quality.Check("t", "id", "unique"), quality.Check("gone", "id", "unique")])
    got = {(r.table, r.column): (r.failures, r.errored, r.passed) for r in result.collect()}
    assert got == {("t", "nope"): (1, True, False), ("t", "id"): (0, False, True), ("gone", "id"): (1, True, False)}


def test_declared_assertions():
    checks = quality.declared_checks()
    kinds = [c.kind for c in checks]
    assert len(checks) == 174
    assert [kinds.count(k) for k in ("unique", "not_null", "accepted_values", "relationships")] == [16, 128, 18, 12]


def test_first_request_wins(spark):
    df = spark.createDataFrame([("u", "k", 2, "b"), ("u", "k", 1, "a"), ("u", "k", 3, "a"), ("u", "z", 1, "a")], "user string, key string, at int, body string")
    kept = {r.key: (r.first_at, r.requests, r.conflicts) for r in quality.first_requests(df, "user", "key", "at", ["body"]).collect()}
    assert kept == {"k": (1, 3, 1), "z": (1, 1, 0)}
    assert [r.at for r in quality.conflicting_requests(df, "user", "key", "at", ["body"]).collect()] == [2]


@pytest.mark.parametrize("subtotal,shipping", [("74.99", "5.99"), ("75.00", "0.00")])
def test_shipping_threshold(spark, subtotal, shipping):
    df = spark.createDataFrame([("VIP",)], "customer_segment string").withColumn("subtotal", F.lit(subtotal).cast("decimal(18,2)"))
    row = quality.priced(df).first()
    assert str(row.expected_shipping) == shipping
    assert float(row.expected_discount) == round(float(subtotal) * 0.1 + 1e-9, 2)


def test_materialised_models_read_back(spark, folder, shop_tables):
    w = Warehouse(shop_tables, date(2024, 5, 1))
    tables = materialise(w, folder, ("dim_users", "fct_orders"))
    assert rows(tables["fct_orders"]) == rows(w.fct_orders)


def test_later_models_read_the_written_ones(spark, folder, shop_tables, monkeypatch):
    from merchlens.operators import dimensions

    w, seen, real = Warehouse(shop_tables, date(2024, 5, 1)), [], dimensions.dim_users
    expected = rows(w.dim_users)

    def spy(users, sessions, summary, *more, **named):
        seen.append(summary.inputFiles())
        return real(users, sessions, summary, *more, **named)

    monkeypatch.setattr(dimensions, "dim_users", spy)
    tables = materialise(w, folder, ("int_user_order_summary", "dim_users"))
    assert len(seen) == 1 and seen[0] and all("/int_user_order_summary/" in f for f in seen[0])
    assert rows(tables["dim_users"]) == expected


def test_keys_meet_in_one_shuffle(spark):
    """Whole numbers stay numbers; keys of another type meet in the parent's."""
    parent = spark.createDataFrame([(1, "a"), (2, "a"), (2, "b"), (None, None)], "id int, name string")
    child = spark.createDataFrame([("01", "a", 2), ("x", "c", 3), ("x", "c", 2**40), (None, None, None)], "p string, n string, q bigint")
    checks = [quality.Check("parent", "id", "unique"), quality.Check("parent", "name", "unique")]
    checks += [quality.Check("child", c, "relationships", parent=("parent", k)) for c, k in [("p", "id"), ("n", "name"), ("q", "id")]]
    found = quality.key_failures({"parent": parent, "child": child}, checks)
    assert tuple(found.first()) == (1, 1, 2, 2, 2)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "ObjectHashAggregate" not in plan


def test_work_folder_is_below_the_shared_one(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    made = work_dir(spark, "x")
    assert made.startswith(shared) if shared else made
    assert work_dir(spark, "x") != made


def test_ledger_remembers_between_batches(spark, folder):
    from merchlens.streaming.ledger import Ledger

    ledger = Ledger(spark, folder, "user", "key", "at", ["what"])
    kind = "at int, user string, key string, what string"
    first = spark.createDataFrame([(2, "u", "k", "b"), (1, "u", "k", "a"), (3, "u", "k", "a"), (4, None, "k", "a"), (5, "u", None, "x")], kind)
    second = spark.createDataFrame([(6, "u", "k", "a"), (7, "u", "k", "c"), (8, "v", "k", "a"), (9, "u", None, "x")], kind)
    ledger.add(0, first)
    for _ in range(2):
        ledger.add(1, second)
    got = {r.at: (r.batch, r.outcome) for r in ledger.outcomes().collect()}
    assert got == {
        1: (0, "first"), 2: (0, "conflict"), 3: (0, "replay"), 4: (0, "first"), 5: (0, "first"),
        6: (1, "replay"), 7: (1, "conflict"), 8: (1, "first"), 9: (1, "first"),
    }
    ledger.add(2, spark.createDataFrame([], kind))
    assert ledger.outcomes().count() == 9


def test_ledger_stream(spark, folder):
    from merchlens.streaming import ledger

    source, kind = f"{folder}/in", "at int, user string, key string, what string"
    for rows_in in ([(1, "u", "k", "a")], [(2, "u", "k", "a"), (3, "u", "k", "b")]):
        spark.createDataFrame(rows_in, kind).write.mode("append").parquet(source)
        stream = changes.change_stream(spark, source, kind)
        changes.finish(ledger.ledger_stream(stream, f"{folder}/l", f"{folder}/cp", "user", "key", "at", ["what"]))
    got = ledger.Ledger(spark, f"{folder}/l", "user", "key", "at", ["what"]).outcomes()
    assert rows(got.select("at", "outcome")) == [(1, "first"), (2, "replay"), (3, "conflict")]


def test_broken_lines_are_kept_whole(spark, folder):
    from merchlens.sources.datasets import read_checked

    lines = ["id,day,name", "1,2024-01-01,a", "x,2024-01-01,b", "3,2024-13-01,c", "4,2024-01-04", "5,2024-01-05,e,f", '6,,"g,h"', "7,2024-01-07,"]
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(folder + "/t")
    good, broken = read_checked(spark, folder + "/t", "id int, day date, name string")
    assert rows(good.select("id", "name")) == [(1, "a"), (6, "g,h"), (7, None)]
    assert rows(broken.select("record")) == [("3,2024-13-01,c",), ("4,2024-01-04",), ("5,2024-01-05,e,f",), ("x,2024-01-01,b",)]


def test_parity_joins_only_buckets_that_differ(spark):
    from merchlens.sources import sinks

    left = spark.range(500).select("id", (F.col("id") * 0.1).alias("v"), F.when(F.col("id") % 9 > 0, "x").alias("s"))
    assert tuple(sinks.parity(left, left.withColumn("v", F.col("v").cast("float").cast("double")), "id").first()) == (500, 500, 0, 0, 0, 0)
    changed = left.withColumn("v", F.when(F.col("id") == 7, 9.0).when(F.col("id") == 8, F.col("v") + 0.005).otherwise(F.col("v")))
    changed = changed.withColumn("s", F.when(F.col("id") == 9, "x").otherwise(F.col("s"))).where("id <> 100")
    assert tuple(sinks.parity(left, changed, "id").first()) == (500, 499, 1, 0, 1, 1)
    a, b = (sinks.checksums(df, "id", ["v", "s"], 64) for df in (left, changed))
    assert a.exceptAll(b).count() <= 4


@pytest.mark.parametrize("columns", [["a", "b", "c"], ["c", "a"]])
def test_every_cluster_column_skips_files(spark, folder, columns):
    """Rows stay whole, nulls too; each column's filter reads a small part of the files."""
    from merchlens.sources import sinks

    kinds = {"a": F.col("id") % 61, "b": F.concat(F.lit("n"), F.lpad((F.col("id") * 7 % 53).cast("string"), 2, "0")), "c": (F.col("id") * 11 % 47).cast("double")}
    df = spark.range(6000).select("id", *(F.when(F.col("id") % 100 > 0, e).alias(n) for n, e in kinds.items()))
    sinks.write_dimension(df, folder + "/t", columns, files=64)
    stored = spark.read.parquet(folder + "/t")
    assert stored.exceptAll(df).isEmpty() and stored.count() == 6000
    for column in columns:
        value = df.where(f"{column} IS NOT NULL AND id = 1234").first()[column]
        found = sinks.files_to_read(stored, column, value).first()
        assert found.files > 40 and found.files_read < 0.6 * found.files


def test_keys_of_several_types_in_one_pass(spark):
    """Numbers of different width meet, text that is no number is an orphan, null keys pass, a hot key is one row."""
    parent = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id bigint")
    child = spark.createDataFrame([(1, "1"), (3, "2"), (3, "x"), (None, None)], "small int, txt string")
    checks = [
        quality.Check("p", "id", "unique"),
        quality.Check("c", "small", "relationships", parent=("p", "id")),
        quality.Check("c", "txt", "relationships", parent=("p", "id")),
        quality.Check("c", "small", "unique"),
    ]
    results = quality.run_checks({"p": parent, "c": child}, checks)
    got = {(r.table, r.column, r.kind): r.failures for r in results.collect()}
    assert got == {("p", "id", "unique"): 1, ("c", "small", "relationships"): 2, ("c", "txt", "relationships"): 1, ("c", "small", "unique"): 1}
