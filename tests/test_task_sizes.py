"""Tasks that do not grow with the input: shuffles, scans and the join of the feed's tables."""

import datetime as dt
import re

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from ridemart import session
from ridemart.sources import testdata


@pytest.fixture
def restored(spark):
    yield
    session.reset_tasks(spark)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_partitions_grow_with_the_input_files(spark, tmp_path, restored):
    for name, mb in (("small", 1), ("large", 400)):
        (tmp_path / name).mkdir()
        with open(tmp_path / name / "f", "wb") as f:
            f.truncate(mb << 20)
    held = {k: spark.conf.get(k, None) for k in (session.INITIAL_PARTITIONS, *session.TASK_SIZES)}
    session.size_tasks(spark, [f"{tmp_path}/small", f"{tmp_path}/missing"])
    few = int(spark.conf.get(session.INITIAL_PARTITIONS))
    session.size_tasks(spark, [f"{tmp_path}/large", f"{tmp_path}/small"])
    assert int(spark.conf.get(session.INITIAL_PARTITIONS)) == max(few, 101)
    assert all(spark.conf.get(k) == f"{session.TASK_BYTES}b" for k in session.TASK_SIZES)
    session.reset_tasks(spark)
    assert held == {k: spark.conf.get(k, None) for k in held}


def _tables(spark, path):
    day = dt.date(1996, 1, 2)
    rows = {
        "nation": [Row(n_nationkey=1, n_name="N1"), Row(n_nationkey=2, n_name="N2")],
        "customer": [Row(c_custkey=k, c_name=f"C{k}", c_nationkey=1, c_acctbal=1.5, c_mktsegment="m") for k in (1, 1, 2)],
        "supplier": [Row(s_suppkey=7, s_nationkey=2, s_acctbal=0.5)],
        "orders": [Row(o_orderkey=k, o_custkey=c, o_orderstatus="F", o_orderdate=day, o_orderpriority="x")
                   for k, c in ((1, 1), (2, 9), (3, None), (None, 2))],
        "lineitem": [Row(l_orderkey=k, l_linenumber=1, l_suppkey=s, l_partkey=3, l_tax=0.02, l_discount=0.05, l_quantity=4.0,
                         l_extendedprice=9.0, l_returnflag="R", l_shipdate=day) for k, s in ((1, 7), (2, 7), (3, 8), (4, None), (None, 7))],
    }
    for name, r in rows.items():
        spark.createDataFrame(r).write.parquet(f"{path}/{name}.parquet")


def test_lines_are_dealt_once_and_keep_every_match(spark, tmp_path, restored):
    _tables(spark, tmp_path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    trips = testdata.trips_typed(spark, str(tmp_path))
    plan = trips._jdf.queryExecution().executedPlan().toString()
    # with no side small enough to broadcast, lines meet orders that know their customer already
    below = plan[plan.index("l_orderkey"):]
    assert not re.search(r"hashpartitioning\(o_custkey", plan[:plan.index("hashpartitioning(l_orderkey")]), below
    got = sorted((r.booking_id, r.booked_by or "", r.pickup_zone or "", r.destination_zone or "") for r in trips.collect())
    assert got == [("1", "", "", "N2"), ("1-1", "C1", "N1", "N2"), ("1-1", "C1", "N1", "N2"), ("2-1", "", "", "N2"),
                   ("3-1", "", "", ""), ("4-1", "", "", "")]


def test_latest_bookings_are_the_same_within_their_orders(spark, tmp_path, restored):
    from ridemart.operators import silver
    _tables(spark, tmp_path)
    lines = spark.read.parquet(f"{tmp_path}/lineitem.parquet")
    n = F.col("l_linenumber").cast("int")
    odd = lines.where("l_orderkey = 3")  # ids "3" of a line without an order and of an order without a line number
    more = lines.withColumn("l_linenumber", n).union(lines.withColumn("l_linenumber", n).withColumn("l_extendedprice", F.lit(8.0))).union(
        odd.withColumn("l_orderkey", F.lit(None).cast("long")).withColumn("l_linenumber", F.lit(3))).union(
        odd.withColumn("l_linenumber", F.lit(None).cast("int")).withColumn("l_extendedprice", F.lit(7.0)))
    more.write.parquet(f"{tmp_path}/more/lineitem.parquet")
    for name in ("nation", "customer", "supplier", "orders"):
        spark.read.parquet(f"{tmp_path}/{name}.parquet").write.parquet(f"{tmp_path}/more/{name}.parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    within = (testdata.ORDER_OR_LINE,)
    latest = silver.silver_from_typed(testdata.trips_typed(spark, f"{tmp_path}/more", within), "1999-01-01", within)
    plain = silver.silver_from_typed(testdata.trips_typed(spark, f"{tmp_path}/more"), "1999-01-01")
    rows = sorted(latest.collect(), key=str)
    assert rows == sorted(plain.collect(), key=str)
    assert [r.booking_id for r in sorted(rows, key=lambda r: r.booking_id)] == ["1", "1-1", "2-1", "3", "3-1", "4-1"]


def test_orders_star_shuffles_lines_once(spark, tmp_path, restored, monkeypatch):
    from ridemart.operators import silver
    _tables(spark, tmp_path)
    within = (testdata.ORDER_OR_LINE,)
    # orders too large to be sent to all tasks, suppliers and nations not
    sizes = {name: spark.read.parquet(f"{tmp_path}/{name}.parquet") for name in ("nation", "supplier")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    held = testdata.table
    monkeypatch.setattr(testdata, "_nation_names", lambda s, d, p: F.broadcast(sizes["nation"].toDF(f"{p}_nationkey", f"{p}_zone")))
    monkeypatch.setattr(testdata, "table", lambda s, d, name: F.broadcast(sizes[name]) if name in sizes else held(s, d, name))
    latest = silver.silver_from_typed(testdata.trips_typed(spark, str(tmp_path), within), "1999-01-01", within)
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(l_orderkey_or_line" in plan and "hashpartitioning(booking_id" not in plan
    assert "WindowGroupLimit" in plan


def test_landings_are_written_once(spark, tmp_path, restored, monkeypatch):
    from ridemart.plans import extra
    _tables(spark, tmp_path)
    written, export = [], extra.files.export_csv
    monkeypatch.setattr(extra.files, "export_csv", lambda df, path: (written.append(path), export(df, path))[1])
    got = {r.step: r["rows"] for r in extra.two_landings(spark, str(tmp_path)).collect()}
    assert got["run_1"] + got["run_2"] == got["table"] == 6 and got["run_3"] == 0
    assert len(written) == 2 and all("/land/" in p for p in written)


def test_landed_bookings_are_compressed_and_all_read(spark, tmp_path, restored, monkeypatch):
    from ridemart.plans import extra
    from ridemart.plans.checks import ingest_metadata
    _tables(spark, tmp_path)
    spark.createDataFrame([Row(event_id=k, event_type="x", value=1.5) for k in (1, 2, 3)]).write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(extra.files, "FILE_ROWS", 2)
    landed = extra.files.landed_files(spark, extra.landing_bookings(spark, str(tmp_path)), "part-*")
    assert landed and all(f.endswith(".csv.gz") for f in landed)
    assert max(spark.read.text(f).count() for f in landed) <= 3  # two rows and the header
    assert not [k for k in extra._STAGED if k[1:] == ("bronze_text", str(tmp_path))]  # the text is landed without a table between
    counts = {"good_rows": 6, "malformed_rows": 3}
    assert extra.EXTRA_QUERIES["DQ3_ingest_malformed_counts"](spark, str(tmp_path)).first().asDict() == counts
    assert ingest_metadata(spark, str(tmp_path)).first().asDict() == {"with_time": 9, "with_file": 9, "without_file": 0}
    held = extra.ingest.read_bronze(spark, extra.bronze_stream_table(spark, str(tmp_path)))
    assert held.count() == 9


def test_weather_is_built_without_bookings(spark, tmp_path, restored, monkeypatch):
    from ridemart.plans import catalog, warehouse
    _tables(spark, tmp_path)
    lines = spark.read.parquet(f"{tmp_path}/lineitem.parquet")
    lines.withColumn("l_linenumber", F.col("l_linenumber").cast("int")).write.parquet(f"{tmp_path}/typed/lineitem.parquet")
    monkeypatch.setattr(warehouse, "build_star", lambda *a: pytest.fail("no bookings are read"))
    assert catalog.QUERIES["FLT3_silver_weather"](spark, f"{tmp_path}/typed").count() == 3
    assert catalog.QUERIES["AGG1_weather_daily"](spark, f"{tmp_path}/typed").count() == 1


def test_model_rows_are_computed_once_in_few_partitions(spark, tmp_path):
    from ridemart.operators import features as FE
    from ridemart.operators import model as M
    columns = [F.col("id").cast("double").alias(c) for c in FE.NUMERIC_FEATURES] + [F.lit("a").alias(c) for c in FE.CATEGORICAL_FEATURES]
    spark.range(60, numPartitions=9).select(*columns, F.col("id").cast("double").alias(FE.TARGET)).write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    train, test, medians = M.prepare(rows, rows)
    assert train.inputFiles() == [] and test.inputFiles() == []  # medians and models do not read the input again
    assert medians["distance"] == 29.5
    few = M._few_partitions(train.repartition(9))
    assert few.rdd.getNumPartitions() == M.LEAST_PARTITIONS and few.count() == 60
