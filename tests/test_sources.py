from __future__ import annotations

import json
import os
from datetime import datetime

import pytest
from conftest import as_dicts
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerlake.functions import fixed_values as fixed
from layerlake.operators.aggregates import tagged_counts
from layerlake.sinks import tables as sink
from layerlake.sources import catalog, files, lookups, metrics_log
from layerlake.streaming import incremental

PRODUCTS = T.StructType(
    [
        T.StructField("product_id", T.StringType()),
        T.StructField("list_price", T.DoubleType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv_typed(spark, tmp_path):
    path = write(tmp_path / "p.csv", "product_id,list_price,created_at\nprd_1,68.90,2022-12-13 17:49:51\n")
    df = files.read_csv(spark, path, PRODUCTS)
    assert df.schema == PRODUCTS
    assert df.first() == ("prd_1", 68.9, datetime(2022, 12, 13, 17, 49, 51))


def test_csv_bad_value_fails(spark, tmp_path):
    path = write(tmp_path / "p.csv", "product_id,list_price,created_at\nprd_1,dear,2022-12-13 17:49:51\n")
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ_FILE"):
        files.read_csv(spark, path, PRODUCTS).collect()


def test_csv_quarantine(spark, tmp_path):
    path = write(tmp_path / "p.csv", "product_id,list_price,created_at\na,1.5,2022-12-13 17:49:51\nb,dear,2022-12-13 17:49:51\n")
    good, bad = files.read_csv_with_quarantine(spark, path, PRODUCTS)
    assert [r["product_id"] for r in good.collect()] == ["a"]
    assert [r[0] for r in bad.collect()] == ["b,dear,2022-12-13 17:49:51"]
    assert bad.count() == 1


def test_nested_json(spark, tmp_path):
    states = [{"id": 13, "sigla": "AM", "nome": "Amazonas", "regiao": {"id": 1, "sigla": "N", "nome": "Norte"}}]
    path = write(tmp_path / "s.json", json.dumps(states))
    df = files.read_nested_json(spark, path)
    assert set(df.columns) == {"id", "sigla", "nome", "regiao_id", "regiao_sigla", "regiao_nome"}
    assert df.first()["regiao_nome"] == "Norte"
    lines = write(tmp_path / "l.json", "\n".join(json.dumps(s) for s in states * 2))
    assert files.read_nested_json(spark, lines, multiline=False).count() == 2


def test_listing_and_ingest_columns(spark, tmp_path):
    folder = tmp_path / "in"
    spark.range(10).coalesce(1).write.parquet(str(folder))
    listed = files.list_files(spark, str(folder), "*.parquet")
    assert listed.columns == ["path", "length", "modificationTime"]
    assert listed.first()["length"] > 0
    marked = files.with_ingest_columns(spark.read.parquet(str(folder)))
    row = marked.first()
    assert row["_source_file"].endswith(".parquet") and row["_ingested_at"] is not None
    assert files.without_ingest_columns(marked).columns == ["id"]


def test_modified_after(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for name, day in (("old", 1), ("new", 20)):
        path = write(folder / f"{name}.csv", f"product_id,list_price,created_at\n{name},1,2022-01-01 00:00:00\n")
        stamp = datetime(2024, 1, day).timestamp()
        os.utime(path, (stamp, stamp))
    source = files.FileSource(str(folder), "csv", PRODUCTS, {"header": "true"})
    late = files.read_modified_after(spark, source, datetime(2024, 1, 10))
    assert [r["product_id"] for r in late.collect()] == ["new"]
    assert files.read_source(spark, source).count() == 2


def test_landing_copy_is_unchanged(spark, small, tmp_path):
    source = files.FileSource(f"{small}/orders.parquet")
    landed = files.land_raw_copy(spark, source, str(tmp_path / "landing"))
    raw = spark.read.parquet(source.path)
    assert landed.schema == raw.schema
    assert landed.exceptAll(raw).count() == raw.exceptAll(landed).count() == 0


def test_ingest_all_twice_is_once(spark, small):
    sources = {n: files.FileSource(f"{small}/{n}.parquet") for n in ("region", "nation")}
    for _ in range(2):
        assert files.ingest_all(spark, sources, "bronze_t") == ["region", "nation"]
    read = catalog.namespace_reader(spark, "bronze_t")
    counts = {r["table_name"]: r["n_rows"] for r in tagged_counts({n: read(n) for n in sources}).collect()}
    assert counts == {"region": 5, "nation": 25}
    assert catalog.read_table(spark, "bronze_t.nation").count() == 25
    names = {r["table_name"] for r in catalog.list_tables(spark, "bronze_t").collect()}
    assert names == {"region", "nation"}
    got = catalog.query_table(spark, "bronze_t.nation", "SELECT count(*) AS n FROM IDENTIFIER(:t) WHERE n_regionkey = :r", r=2)
    assert got.first()["n"] == 5
    sink.drop_tables(spark, ["bronze_t.region", "bronze_t.nation", "bronze_t.absent"])
    assert catalog.list_tables(spark, "bronze_t").count() == 0


def test_state_lookup(spark):
    states = lookups.states(spark)
    assert states.count() == 27 == len({s for s, _, _ in fixed.STATES})
    by_region = {r["region"]: r["count"] for r in states.groupBy("region").count().collect()}
    assert by_region == {"Norte": 7, "Nordeste": 9, "Centro-Oeste": 4, "Sudeste": 4, "Sul": 3}
    people = spark.createDataFrame([(1, "AM"), (2, "XX")], "id int, state string")
    rows = as_dicts(lookups.with_region(people, states), "id")
    assert [r["region"] for r in rows] == ["Norte", None]


def test_metrics_log(spark):
    text = '[{"name":"r","passed_records":3,"failed_records":1}]'
    log = spark.createDataFrame(
        [("t", 1, text), ("t", 2, text.replace("3", "4")), ("t", 3, None)], "d string, at int, j string"
    )
    rows = metrics_log.exploded_metrics(log, F.col("d"), F.col("at"), F.col("j"))
    assert rows.count() == 2
    assert metrics_log.latest_metrics(rows).first()["passed"] == 4


def test_incremental_load_takes_each_file_once(spark, tmp_path):
    source, target, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    spark.range(5).write.parquet(source)

    def load():
        return incremental.load_new_files(incremental.new_files(spark, source, "id bigint"), target, mark)

    assert load() == 5
    assert load() == 0
    spark.range(5, 8).write.mode("append").parquet(source)
    assert load() == 3
    out = spark.read.parquet(target)
    assert sorted(r["id"] for r in out.collect()) == list(range(8))
    assert out.where(F.col("_source_file").isNull() | F.col("_ingested_at").isNull()).count() == 0


def test_incremental_load_of_many_batches_and_a_replay(spark, tmp_path):
    """More batches than Spark keeps reports of, then the last one again, as after a crash before it was marked done."""
    source, target, mark = (tmp_path / n for n in ("in", "out", "mark"))
    spark.range(0, 315, 1, 105).write.parquet(str(source))

    def load():
        stream = incremental.new_files(spark, str(source), "id bigint", maxFilesPerTrigger="1")
        return incremental.load_new_files(stream, str(target), str(mark))

    assert load() == 315
    batches = sorted(int(p.name.split("=")[1]) for p in target.glob("batch_id=*"))
    assert len(batches) == 105
    before = {p: p.stat().st_mtime_ns for p in target.rglob("*.parquet")}
    for name in (str(batches[-1]), f".{batches[-1]}.crc"):
        (mark / "commits" / name).unlink(missing_ok=True)
    assert load() == 0
    assert {p: p.stat().st_mtime_ns for p in target.rglob("*.parquet")} == before
    out = spark.read.parquet(str(target))
    assert sorted(r["id"] for r in out.collect()) == list(range(315))


def test_an_interrupted_batch_is_replaced(spark, tmp_path):
    target = str(tmp_path / "out")
    spark.range(3).write.parquet(f"{target}/batch_id=4")
    (tmp_path / "out" / "batch_id=4" / "_SUCCESS").unlink()
    assert incremental.append_batch(spark.range(10, 15), target, 4) == 5
    assert incremental.append_batch(spark.range(10, 15), target, 4) == 0
    assert sorted(tuple(r) for r in spark.read.parquet(target).collect()) == [(i, 4) for i in range(10, 15)]


def test_fields_of_changing_shape(spark):
    from layerlake.functions import variants

    texts = ['{"k": 1, "a": [{"b": "x"}]}', '{"k": "1"}', '{"k": null}', "{}", "{broken", "", None, "[1]", '{"k": 1.5}', '{"k": {"k": 2}}', "7"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    rows = variants.parsed(df, "t")
    state = variants.field_state("t", "fields", "$.k", "BIGINT")
    got = [r.s for r in rows.select("id", state.alias("s")).orderBy("id").collect()]
    assert got == ["present", "wrong_type", "missing", "missing", "malformed", "malformed", "missing", "missing", "wrong_type", "wrong_type", "missing"]
    first = rows.orderBy("id").select(variants.field("fields", "$.a[0].b", "string").alias("b"), variants.field("fields", "$.k", "bigint").alias("k")).first()
    assert tuple(first) == ("x", 1)
    good, bad = variants.split_malformed(df, "t")
    assert sorted(r.id for r in bad.collect()) == [4, 5] and bad.columns == df.columns and good.count() == len(texts) - 2
    assert "k: " in variants.observed_schema(rows.where("id IN (0, 3)"), "fields").first().observed


def test_intermediate_tables_are_dropped(spark):
    from pathlib import Path

    from layerlake.session import intermediate, materialize

    with intermediate(spark) as made:
        one = materialize(spark.range(5))
        two = materialize(one.where("id > 2"))
        kept = made.pop()
        first = list(made)
    assert two.count() == 2 and Path(kept.removeprefix("file:")).is_dir()
    assert len(first) == 1 and not Path(first[0].removeprefix("file:")).exists()
    assert materialize(spark.range(3)).count() == 3  # nothing is recorded outside
