"""Stored tables: swaps, logs by day, load audits, runs that are gone on with, Bloom filters at the scan."""

from __future__ import annotations

import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from martwright.operators.bloom import bloom_filter
from martwright.plans import gold, monitoring, refresh
from martwright.sources import landing, tables
from martwright.sources.logs import Log
from martwright.sources.tables import Layout, rebuild_table, versions

AT = dt.datetime(2024, 1, 2, 3, 4, 5)


@pytest.fixture
def schema(spark, request):
    name = f"s_{abs(hash(request.node.name))}"
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")
    yield name
    spark.sql(f"DROP SCHEMA {name} CASCADE")


class Stop(Exception):
    pass


def test_a_rebuild_that_stops_between_its_steps_leaves_the_old_table(spark, schema, monkeypatch):
    name = f"`{schema}`.`t`"
    rebuild_table(spark.range(3).toDF("id"), name)

    def stop(*_):
        raise Stop

    with monkeypatch.context() as m:
        m.setattr(tables, "point_to", stop)  # the new version is written, nothing points to it
        with pytest.raises(Stop):
            rebuild_table(spark.range(5).toDF("id"), name)
    assert spark.table(name).count() == 3 and len(versions(spark, name)) == 2
    with monkeypatch.context() as m:
        m.setattr(tables, "versions", stop)  # pointed to, but the old versions are still there
        with pytest.raises(Stop):
            rebuild_table(spark.range(7).toDF("id"), name)
    assert spark.table(name).count() == 7
    rebuild_table(spark.range(9).toDF("id"), name)
    assert spark.table(name).count() == 9
    # the present version and the one before; what failed is gone
    assert len(versions(spark, name)) == 2


def test_a_query_that_has_begun_reads_its_version(spark, schema):
    name = f"`{schema}`.`t`"
    rebuild_table(spark.range(3).toDF("id"), name)
    begun = spark.table(name)
    rebuild_table(spark.range(5).toDF("id"), name)
    assert begun.count() == 3 and spark.table(name).count() == 5


def test_readers_find_a_table_at_any_time(spark, schema):
    name = f"`{schema}`.`t`"
    rebuild_table(spark.range(10).toDF("id"), name)
    seen, failed, done = [], [], threading.Event()

    def read():
        while not done.is_set():
            try:
                seen.append(spark.table(name).count())
            except Exception as error:  # noqa: BLE001
                failed.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for n in range(11, 17):
            rebuild_table(spark.range(n).toDF("id"), name)
    finally:
        done.set()
        reader.join()
    assert failed == [] and seen == sorted(seen) and len(seen) > 5


def test_columns_may_change_and_plain_tables_become_versions(spark, schema):
    name = f"`{schema}`.`t`"
    spark.range(4).write.saveAsTable(name)
    rebuild_table(spark.range(2).selectExpr("id", "'x' AS extra"), name)
    assert spark.table(name).columns == ["id", "extra"]
    assert [spark.table(v).count() for v in versions(spark, name)] == [4, 2]
    rebuild_table(spark.range(1).toDF("id"), name)
    assert [spark.table(v).count() for v in versions(spark, name)] == [2, 1]
    # another table whose name goes on where this one ends
    other = f"`{schema}`.`t2`"
    rebuild_table(spark.range(6).toDF("id"), other)
    rebuild_table(spark.range(1).toDF("id"), name)
    assert spark.table(other).count() == 6


def log_of(spark, schema, appends=5) -> Log:
    return Log(spark, f"`{schema}`.`events`", "timestamp timestamp_ntz, record string, value string", "timestamp", appends)


def test_a_log_has_few_files_and_filters_on_days(spark, schema, plan_of):
    log = log_of(spark, schema, appends=10)
    assert log.read().count() == 0
    moments = [dt.datetime(2024, 1, 1 + i // 34, 10, i % 60) for i in range(100)]
    for i, moment in enumerate(moments):
        log.append([(moment, '{"severity_text": "INFO"}', f"m{i}")])
    assert sorted(r["value"] for r in log.read().collect()) == sorted(f"m{i}" for i in range(100))
    # 100 appends, one file per day and batch in the archive and ten recent ones at most
    assert len(log.read().inputFiles()) <= 100 // 10 + 3 + 11
    recent = monitoring.recent_logs(log.read(), moments[-1])
    archive = [line for line in plan_of(recent).splitlines() if "events__archive" in line]
    assert archive and all("PartitionFilters" in line and "day#" in line.split("PartitionFilters")[1].split("PushedFilters")[0] for line in archive)
    want = [f"m{i}" for i, m in enumerate(moments) if m >= moments[-1] - dt.timedelta(hours=24)]
    assert sorted(r["message"] for r in recent.collect()) == sorted(want)


def test_archiving_that_stops_loses_and_repeats_nothing(spark, schema, monkeypatch):
    log = log_of(spark, schema, appends=100)
    for i in range(3):
        log.append([(AT, None, f"m{i}")])
    with monkeypatch.context() as m:
        m.setattr(Log, "_begin", lambda self: (_ for _ in ()).throw(Stop()))  # archived, but not yet shown
        with pytest.raises(Stop):
            log.compact()
    assert log.read().count() == 3
    log.append([(AT, None, "m3")])
    log.compact()
    assert sorted(r["value"] for r in log.read().collect()) == ["m0", "m1", "m2", "m3"]
    log.append([(AT + dt.timedelta(days=1), None, "m4")])
    assert log.read().count() == 5


def test_records_are_parsed_once_and_malformed_ones_are_null(spark, schema):
    log = Log(spark, f"`{schema}`.`events`", refresh.SCHEMAS[refresh.EVENT_LOG], "timestamp")
    rows = [(AT, '{"severity_text": "WARN"}', "a"), (AT, "{no json", "b"), (AT, None, "c"), (AT, '{"other": 1}', "d"), (AT, "[1]", "e")]
    log.append(monitoring.with_record(spark.createDataFrame(rows, "timestamp timestamp_ntz, record string, value string")))
    assert dict(log.read().dtypes)["record"] == "variant"
    found = {r["message"]: r["severity"] for r in monitoring.recent_logs(log.read(), AT).collect()}
    assert found == {"a": "WARN", "b": None, "c": None, "d": None, "e": None}


def test_ten_thousand_files_reach_the_driver_as_names_of_tables(spark, tmp_path):
    odd = "People [1],{x}.CSV"
    names = [odd, *(f"t{i:03}.csv" for i in range(499))]
    for i in range(20):
        folder = tmp_path / f"day {i}+"
        folder.mkdir()
        for name in names:
            (folder / name).write_text(f"id,name\n{i},a\n")
    found = landing.landing_tables(spark, str(tmp_path))
    # 10,000 files, 500 names
    assert [(t.table, t.files.names, t.n_files) for t in found] == [(landing.raw_table_name(n), (n,), 20) for n in names]
    assert {t.size for t in found} == {sum(len(f"id,name\n{i},a\n") for i in range(20))}
    rows = landing.read_landing(spark, found[0].files, AT, multi_line=False)
    assert sorted(int(r["ID"]) for r in rows.collect()) == list(range(20))
    assert [r[0] for r in rows.select("_SOURCE_FILE").distinct().collect()] == [odd]


def test_files_by_name_with_quoted_line_breaks(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"f{k}").mkdir()
        (tmp_path / f"f{k}" / "notes.csv").write_text(f'id,msg\n{k},"two\nlines"\n')
        (tmp_path / f"f{k}" / "mynotes.csv").write_text("x\n1\n")
    other, notes = landing.landing_tables(spark, str(tmp_path))
    assert (other.table, notes.table) == ("RAW_MYNOTES", "RAW_NOTES")
    rows = landing.read_landing(spark, notes.files, AT)
    assert sorted((r["ID"], r["MSG"]) for r in rows.collect()) == [(str(k), "two\nlines") for k in range(3)]


def test_the_audit_has_every_load(spark, schema, tmp_path, monkeypatch):
    (tmp_path / "a.csv").write_text("id,name\n1,a\n2,b\n3\n")
    audit = landing.load_audit(spark, f"`{schema}`.`load_audit`")
    counted = []
    original = landing.append_audited
    monkeypatch.setattr(landing, "append_audited", lambda df, table, files=1, rows_before=None: counted.append(rows_before) or original(df, table, files, rows_before))
    for _ in range(3):
        landing.ingest(spark, str(tmp_path), lambda t: f"`{schema}`.`{t}`", AT, audit)
    rows = audit.read().orderBy("rows_total").collect()
    assert [(r["files"], r["rows_loaded"], r["rows_rejected"], r["rows_total"]) for r in rows] == [(1, 2, 1, 2), (1, 2, 1, 4), (1, 2, 1, 6)]
    assert {r["bytes"] for r in rows} == {(tmp_path / "a.csv").stat().st_size}
    assert spark.table(f"`{schema}`.`RAW_A`").count() == 6
    # only the first load had to look at the table
    assert counted == [None, 2, 4]


def test_a_run_is_gone_on_with_where_it_failed(spark, monkeypatch):
    layout = Layout(bronze="r_bronze", silver="r_silver", gold="r_gold", semantic="r_semantic", log="r_log")
    layout.create_schemas(spark)
    built, failing = [], {"t4"}

    def step(name):
        def run():
            if name in failing:
                raise Stop(name)
            built.append(name)

        return run

    monkeypatch.setattr(refresh, "silver_steps", lambda spark, layout: {f"t{i}": step(f"t{i}") for i in range(6)})
    monkeypatch.setattr(refresh, "gold_steps", lambda spark, layout, as_of: {"g0": step("g0")})
    for _ in range(2):  # the fifth table fails twice
        with pytest.raises(Stop):
            refresh.refresh(spark, layers=("silver", "gold"), layout=layout, resume=True)
    assert built == ["t0", "t1", "t2", "t3"]
    failing.clear()
    refresh.refresh(spark, layers=("silver", "gold"), layout=layout, resume=True)
    assert built == ["t0", "t1", "t2", "t3", "t4", "t5", "g0"]
    # that run has ended: the next one builds everything, and so does one that isn't to go on
    refresh.refresh(spark, layers=("silver", "gold"), layout=layout, resume=True)
    refresh.refresh(spark, layers=("gold",), layout=layout)
    assert built[7:] == ["t0", "t1", "t2", "t3", "t4", "t5", "g0", "g0"]
    log = refresh.logs(spark, layout)
    runs = log[refresh.TABLE_LOG].read()
    assert runs.select("run_id").distinct().count() == 3
    assert runs.where("state = 'FAILED'").select("table_name").distinct().collect()[0][0] == "t4"
    assert monitoring.failed_runs(log[refresh.RUN_LOG].read()).count() == 2


@pytest.mark.parametrize("kind", ["string", "long"])
def test_a_bloom_filter_passes_all_keys_and_few_others(spark, kind):
    keys = spark.range(20_000).select((F.col("id") * 3).cast(kind).alias("k")).union(spark.createDataFrame([(None,)], f"k {kind}"))
    rows = spark.range(60_000).select(F.col("id").cast(kind).alias("k")).union(spark.createDataFrame([(None,)], f"k {kind}"))
    passed = rows.where(bloom_filter(keys, "k").passes("k"))
    assert passed.join(keys.dropna(), "k", "left_semi").count() == 20_000
    assert 0 < passed.count() - 20_000 < 0.07 * 40_000
    # no filter for more keys than it has room for, nothing for no keys
    assert rows.where(bloom_filter(keys, "k", most_words=16).passes("k")).count() == 60_000
    assert rows.where(bloom_filter(keys.limit(0), "k").passes("k")).count() == 0


def shuffled_rows(spark, df) -> int:
    """Rows that all shuffles of ``df`` write, by the metrics of the plan that ran."""
    df.collect()
    plans, total = [df._jdf.queryExecution().executedPlan()], 0
    while plans:
        plan = plans.pop()
        kind = plan.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            plans.append(plan.executedPlan())
            continue
        if kind == "ShuffleExchangeExec":
            total += plan.metrics().apply("shuffleRecordsWritten").value()
        if kind.endswith("QueryStageExec"):
            plans.append(plan.plan())
        children = plan.children()
        plans += [children.apply(i) for i in range(children.size())]
    return total


def test_the_fact_table_reads_items_of_surviving_orders_alone(spark, schema):
    orders = spark.range(300).select(F.col("id").cast("string").alias("order_id"))
    times = ("order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date")
    orders = orders.withColumns({"customer_id": F.lit("c"), "order_status": F.lit("D")} | {t: F.lit(AT).cast("timestamp_ntz") for t in times})
    items = spark.range(30_000).select(
        (F.col("id") % 10_000).cast("string").alias("order_id"), (F.col("id") % 3).cast("int").alias("order_item_id"), F.lit("p").alias("product_id"), F.lit("s").alias("seller_id"),
        F.lit(1).cast("decimal(24,6)").alias("price"), F.lit(1).cast("decimal(24,6)").alias("freight_value"), F.lit(AT).cast("timestamp_ntz").alias("shipping_limit_date"),
    )
    payments = spark.createDataFrame([], "order_id string, payment_sequential int, payment_installments int, payment_type string, payment_value decimal(24,6)")
    reviews = spark.createDataFrame([], "review_id string, order_id string, review_score int, review_comment_message string, review_creation_date timestamp_ntz")
    for name, df in (("o", orders), ("i", items)):
        rebuild_table(df, f"`{schema}`.`{name}`")
    orders, items = spark.table(f"{schema}.o"), spark.table(f"{schema}.i")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain = gold.fact_orders(orders, items, payments, reviews)
        filtered = gold.fact_orders(orders, items, payments, reviews, bloom=True)
        assert sorted(map(tuple, filtered.collect())) == sorted(map(tuple, plain.collect()))
        without, with_filter = shuffled_rows(spark, plain), shuffled_rows(spark, filtered)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # 900 of 30,000 items are of surviving orders; about one other in 20 passes
    assert without > 30_000 and with_filter < 6_000
