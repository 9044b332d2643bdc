from __future__ import annotations

from dataclasses import replace
from decimal import Decimal as D

import pytest
from conftest import as_dicts
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerlake.sinks import datasets as ds
from layerlake.sinks import tables as sink
from layerlake.sinks.snapshots import SnapshotTable
from layerlake.sources import catalog


@pytest.fixture(scope="module", autouse=True)
def namespace(spark):
    sink.create_namespace(spark, "gold_t", "it's gold")
    yield
    spark.sql("DROP SCHEMA gold_t CASCADE")


def frame(spark, *rows):
    return spark.createDataFrame(rows, "id int, channel string, quantity bigint, price decimal(10,2)")


ROWS = [(1, "e", 2, D("1.00")), (2, "s", 1, D("3.00")), (3, "e", 1, D("0.50"))]


# -- catalog tables ----------------------------------------------------------


def test_overwrite_is_idempotent_and_may_change_the_schema(spark):
    df = frame(spark, *ROWS)
    for _ in range(2):
        assert sink.overwrite_table_counted(df, "gold_t.sales") == 3
    assert spark.table("gold_t.sales").count() == 3
    sink.overwrite_table(df.select("id", F.lit("x").alias("new")), "gold_t.sales", comment="narrow")
    assert spark.table("gold_t.sales").columns == ["id", "new"]
    assert catalog.list_tables(spark, "gold_t").where("table_name = 'sales'").first()["comment"] == "narrow"


def test_table_from_query(spark):
    sink.overwrite_table(frame(spark, *ROWS), "gold_t.base")
    for _ in range(2):
        sink.table_from_query(spark, "gold_t.copy", "SELECT id FROM gold_t.base WHERE quantity >= :q", q=2)
    assert [r.id for r in spark.table("gold_t.copy").collect()] == [1]


def test_clustered_files_hold_disjoint_ranges(uncoalesced, tmp_path):
    spark = uncoalesced
    df = spark.range(0, 1000, 1, 4).select(F.pmod(F.xxhash64("id"), F.lit(100)).alias("day"), "id")
    sink.overwrite_table(df, "gold_t.by_day", cluster_by=["day"])
    spans = (
        spark.table("gold_t.by_day").groupBy(F.col("_metadata.file_path")).agg(F.min("day").alias("a"), F.max("day").alias("b"))
    ).orderBy("a").collect()
    assert len(spans) > 1
    assert all(x["b"] < y["a"] for x, y in zip(spans, spans[1:]))


def test_append_is_checked(spark):
    sink.overwrite_table(frame(spark, *ROWS), "gold_t.append")
    sink.append_rows(frame(spark, (4, "e", 1, D("1.00"))).select("price", "id", "channel", "quantity"), "gold_t.append")
    assert spark.table("gold_t.append").where("id = 4").first()["price"] == D("1.00")
    bad = frame(spark, *ROWS).withColumn("quantity", F.lit("duas"))
    with pytest.raises(TypeError, match="quantity"):
        sink.append_rows(bad, "gold_t.append")
    with pytest.raises(TypeError, match="missing"):
        sink.append_rows(frame(spark, *ROWS).drop("price"), "gold_t.append")
    with pytest.raises(Exception, match="CANNOT_SAFELY_CAST|CAST_INVALID_INPUT"):
        spark.sql("INSERT INTO gold_t.append VALUES (9, 'e', 'duas', 1.00)")
    assert spark.table("gold_t.append").count() == 4


def test_safe_widening_is_accepted(spark):
    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("d", T.DecimalType(20, 2))])
    df = spark.createDataFrame([(1, 2)], "d int, n int")
    assert sink.checked_for(df, schema).first() == (2, D("1.00"))
    with pytest.raises(TypeError):
        sink.checked_for(df.withColumn("n", F.lit(1.5)), schema)


def test_comments_and_documentation(spark):
    sink.overwrite_table(frame(spark, *ROWS).select("id", "channel"), "gold_t.documented")
    sink.overwrite_table(frame(spark, *ROWS).select("id"), "gold_t.__internal")
    missing = catalog.undocumented_columns(spark, "gold_t").where("table_name = 'gold_t.documented'")
    assert missing.count() == 2
    sink.comment_columns(spark, "gold_t.documented", {"id": "key", "channel": "where it's sold"})
    assert missing.sparkSession.table("gold_t.documented").schema["channel"].metadata["comment"] == "where it's sold"
    left = catalog.undocumented_columns(spark, "gold_t")
    assert left.where("table_name IN ('gold_t.documented', 'gold_t.__internal')").count() == 0
    named = sink.with_comments(frame(spark, *ROWS), {"id": "key"})
    sink.overwrite_table(named, "gold_t.from_frame")
    rows = as_dicts(catalog.describe_columns(spark, ["gold_t.from_frame"]), "column_name")
    assert {r["column_name"]: r["comment"] for r in rows}["id"] == "key"


def test_export(spark, tmp_path):
    sink.export_parquet(frame(spark, *ROWS), str(tmp_path / "out"), partition_by=["channel"])
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 3 and (tmp_path / "out" / "channel=e").is_dir()


# -- snapshots ---------------------------------------------------------------


def test_versions_update_restore(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    assert table.current_version() is None
    with pytest.raises(LookupError):
        table.read()
    assert table.overwrite(frame(spark, *ROWS)) == 0
    assert table.update("channel", "SHOP", F.col("channel") == "s") == 1
    assert table.append(frame(spark, (4, "e", 1, D("1.00")))) == 2
    assert table.overwrite(frame(spark, *ROWS).select("id", "price")) == 3
    assert table.restore(0) == 4
    by_version = [sorted({r.channel for r in table.read(v).collect()}) for v in (0, 1, 2, 4)]
    assert by_version == [["e", "s"], ["SHOP", "e"], ["SHOP", "e"], ["e", "s"]]
    assert table.read(2).count() == 4 and table.read(3).columns == ["id", "price"]
    assert table.read().count() == 3
    log = as_dicts(table.history(), "version")
    assert [r["operation"] for r in log] == ["OVERWRITE", "UPDATE", "APPEND", "OVERWRITE", "RESTORE 0"]
    with pytest.raises(LookupError):
        table.read(9)


def test_refused_append_leaves_the_table(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    table.overwrite(frame(spark, *ROWS))
    with pytest.raises(TypeError):
        table.append(frame(spark, *ROWS).withColumn("quantity", F.lit("duas")))
    assert table.current_version() == 0 and table.read().count() == 3


# -- declared datasets -------------------------------------------------------

SCHEMA = T.StructType(
    [
        T.StructField("channel", T.StringType(), metadata={"comment": "where"}),
        T.StructField("items", T.LongType(), metadata={"comment": "how many"}),
    ]
)


def by_channel(read):
    return read("sales").groupBy("channel").agg(F.sum("quantity").cast("int").alias("items"))


@pytest.fixture
def lake(spark, tmp_path):
    lake = ds.Lake(spark, str(tmp_path / "lake"))
    lake.table("sales").overwrite(frame(spark, *ROWS))
    return lake


def test_refresh_conforms_and_repeats(lake):
    rule = ds.Expectation("positive", "items > 0", ds.FAIL)
    dataset = ds.Dataset("channels", SCHEMA, by_channel, expectations=[rule], cluster_by=["channel"])
    assert lake.refresh(dataset) == ds.Refresh(0, 2, {"positive": 0})
    assert lake.refresh(dataset).version == 1
    out = lake.read("channels")
    assert out.schema == SCHEMA and sorted(out.collect()) == [("e", 3), ("s", 1)]


def test_broken_fail_rule_keeps_the_old_data(spark, lake):
    good = ds.Dataset("channels", SCHEMA, by_channel)
    lake.refresh(good)
    strict = ds.Dataset("channels", SCHEMA, by_channel, expectations=[ds.Expectation("many", "items > 1000000", ds.FAIL)])
    with pytest.raises(ds.ExpectationFailure, match="many"):
        lake.refresh(strict)
    table = lake.table("channels")
    assert table.current_version() == 0
    assert lake.read("channels").count() == 2
    published = table.history().first()["folders"]
    staged = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{table.path}/data")
    left = {r.path.split("/")[-2] for r in staged.select("path").distinct().collect()}
    assert left == {f.split("/")[-1] for f in published}
    row = lake.metrics().where("rule = 'many'").first()
    assert (row["passed"], row["failed"], row["action"]) == (0, 2, "fail")


def test_comment_is_stored_and_stays(lake):
    lake.refresh(ds.Dataset("channels", SCHEMA, by_channel, comment="items by channel"))
    table = lake.table("channels")
    assert table.comment() == "items by channel"
    table.restore(0)
    lake.refresh(ds.Dataset("channels", SCHEMA, by_channel))
    assert table.current_version() == 2 and table.comment() == "items by channel"
    lake.refresh(ds.Dataset("channels", SCHEMA, by_channel, comment="other"))
    assert table.comment() == "other"


def test_warn_counts_and_keeps_then_fails_when_promoted(lake):
    kind = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("price", T.DecimalType(10, 2))])
    rule = ds.Expectation("at_least_one", F.col("price") >= 1)
    refresh = lake.refresh(ds.Dataset("priced", kind, lambda read: read("sales"), expectations=[rule]))
    assert (refresh.rows, refresh.failed) == (3, {"at_least_one": 1})
    promoted = ds.Expectation("at_least_one", F.col("price") >= 1, ds.FAIL)
    with pytest.raises(ds.ExpectationFailure):
        lake.refresh_all([ds.Dataset("priced", kind, lambda read: read("sales"), expectations=[promoted])])


def test_drop_removes_broken_and_undecided_rows(spark, lake):
    lake.table("sales").append(frame(spark, (7, None, None, None)))
    kind = T.StructType([T.StructField("id", T.IntegerType())])
    rule = ds.Expectation("at_least_one", "price >= 1", ds.DROP)
    refresh = lake.refresh(ds.Dataset("kept", kind, lambda read: read("sales"), expectations=[rule]))
    assert (refresh.rows, refresh.failed) == (2, {"at_least_one": 2})
    good, bad = ds.split_on(lake.read("sales"), [rule])
    assert sorted(r.id for r in good.collect()) == [1, 2] and sorted(r.id for r in bad.collect()) == [3, 7]


def test_empty_dataset_counts_zero(spark, lake):
    dataset = ds.Dataset("none", SCHEMA, lambda read: by_channel(read).where("false"), expectations=[ds.Expectation("x", "items > 0", ds.FAIL)])
    assert lake.refresh(dataset) == ds.Refresh(0, 0, {"x": 0})


def test_counts_do_not_depend_on_the_layout(uncoalesced, tmp_path):
    lake = ds.Lake(uncoalesced, str(tmp_path / "lake"))
    lake.table("n").overwrite(uncoalesced.range(0, 1000, 1, 4).toDF("n"))
    kind = T.StructType([T.StructField("n", T.LongType())])
    rule = ds.Expectation("even", F.col("n") % 2 == 0)
    dataset = ds.Dataset("m", kind, lambda read: read("n"), expectations=[rule], cluster_by=["n"])
    assert lake.refresh(dataset) == ds.Refresh(0, 1000, {"even": 500})


# -- the declared layers -----------------------------------------------------


def test_all_layers_refresh_and_reconcile(spark, small, tmp_path):
    from layerlake.operators.checks import CheckFailure
    from layerlake.plans import layers

    lake = ds.Lake(spark, str(tmp_path / "lake"))
    layers.load_raw(lake, small)
    done = lake.refresh_all(layers.datasets())
    assert set(done) == {d.name for d in layers.datasets()}
    again = lake.refresh_all(layers.datasets()[:4])
    assert all(done[n].rows == r.rows and r.version == 1 for n, r in again.items())
    for d in layers.datasets():
        assert lake.read(d.name).schema == d.schema
        assert all(f.metadata.get("comment") for f in d.schema.fields), d.name
    tolerant = replace(layers.TEST_TABLE_SETTINGS, max_unregistered_share=D("0.05"))
    results = layers.checks(lake, tolerant).run()
    assert {r["status"] for r in results} == {"OK"} and len(results) >= 23
    with pytest.raises(CheckFailure, match="unregistered products stay tolerable"):
        layers.checks(lake, replace(tolerant, max_unregistered_share=D("0.0001"))).run()
    warned = lake.metrics().where("action = 'warn' AND failed > 0")
    assert warned.count() > 0
    for scan in (False, True):
        rows = layers.reconciled(lake, scan=scan).collect()
        assert len(rows) == 6 and all(r.is_equal and r.source == ("scan" if scan else "log") for r in rows)


# -- reconciliation from the log ---------------------------------------------


def money_lake(spark, tmp_path):
    lake = ds.Lake(spark, str(tmp_path / "lake"))
    lake.table("raw").overwrite(frame(spark, *ROWS))
    kind = T.StructType([T.StructField("channel", T.StringType()), T.StructField("price", T.DecimalType(10, 2))])
    fine = ds.Dataset("fine", kind, lambda read: read("raw"), expectations=[ds.Expectation("dear", "price >= 1", ds.DROP)], totals=["price"])
    whole = ds.Dataset("whole", kind, lambda read: read("raw").groupBy("channel").agg(F.sum("price").alias("price")), totals=["price"])
    return lake, fine, whole


def test_totals_are_compared_without_reading_the_data(spark, tmp_path, monkeypatch):
    lake, fine, whole = money_lake(spark, tmp_path)
    assert lake.refresh(fine).rows == 2
    lake.refresh(whole)
    monkeypatch.setattr(SnapshotTable, "read", lambda *a: pytest.fail("the data are read"))
    row = lake.reconciled("fine", ["whole", "fine"], "price").collect()
    assert [(r.left, r.right, r.is_equal, r.source) for r in row] == [
        (D("4.00"), D("4.50"), False, "log"), (D("4.00"), D("4.00"), True, "log")]
    assert lake.table("fine").measures() == {"rows": D(2), "price": D("4.00")}


def test_changed_files_are_found_on_request(spark, tmp_path):
    lake, _, whole = money_lake(spark, tmp_path)
    lake.refresh(whole)
    lake.refresh(replace(whole, name="copy", build=lambda read: read("whole")))
    table = lake.table("copy")
    folder = f"{table.path}/{table.history().first()['folders'][0]}"
    spark.range(1).select(F.lit("e").alias("channel"), F.lit("1.00").cast("decimal(10,2)").alias("price")).write.mode("append").parquet(folder)
    assert lake.reconciled("whole", ["copy"], "price").first().is_equal
    found = lake.reconciled("whole", ["copy"], "price", scan=True).first()
    assert (found.left, found.right, found.is_equal, found.source) == (D("4.50"), D("5.50"), False, "scan")
    assert not lake.reconciled("whole", ["copy"], scan=True).first().is_equal


def test_versions_without_measures_are_scanned(spark, tmp_path):
    lake, _, whole = money_lake(spark, tmp_path)
    lake.refresh(whole)
    table = lake.table("whole")
    table.append(spark.createDataFrame([("x", D("0.50"))], table.read().schema))
    row = lake.reconciled("whole", ["raw"], "price").first()
    assert (row.left, row.right, row.source) == (D("5.00"), D("4.50"), "scan") and table.measures() is None
    table.restore(0)
    assert table.measures() == {"rows": D(2), "price": D("4.50")}
    empty = lake.refresh(replace(whole, name="none", build=lambda read: read("raw").where("false")))
    assert empty.rows == 0 and lake.table("none").measures() == {"rows": D(0), "price": None}
