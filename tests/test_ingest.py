import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from opslake.plans.lakehouse import Lakehouse
from opslake.operators.quality import apply_expectations, event_log_rows
from opslake.plans.domains import DATASETS
from opslake.sources.schemas import SchemaRegistry, evolve, infer_schema
from opslake.sources.shards import write_shards
from opslake.sources.test_tables import RAW
from opslake.sources.rescue import bronze_schema
from opslake.streaming import deliveries
from opslake.streaming.deliveries import load_bronze, read_batches
from opslake.streaming.tables import (
    ingest_stream,
    read_table,
    stream_table,
    write_stream,
)

SMALL = StructType().add("id", "long").add("q", "integer").add("at", "timestamp")


def drop_file(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


class Feed:
    """A landing folder and the bronze table fed from it."""

    def __init__(self, spark, root, file_format, schema=SMALL):
        self.spark, self.root, self.format, self.schema = spark, root, file_format, schema
        self.landing = root / "landing"

    def run(self):
        stream = ingest_stream(self.spark, str(self.landing), self.format, self.schema)
        write_stream(stream, str(self.root / "bronze"), str(self.root / "checkpoint"))
        return self.rows()

    def rows(self):
        table = read_table(self.spark, str(self.root / "bronze"), bronze_schema(self.schema))
        return table.drop("_source_file").orderBy("id").collect()


def test_each_file_is_loaded_once(spark, tmp_path):
    feed = Feed(spark, tmp_path, "csv")
    drop_file(feed.landing, "a.csv", "id,q,at\n1,5,2026-01-01 00:00:00\n2,6,\n")
    assert [r.id for r in feed.run()] == [1, 2]
    assert [r.id for r in feed.run()] == [1, 2]
    drop_file(feed.landing, "b.csv", "id,q,at\n3,7,2026-01-02 00:00:00\n")
    rows = feed.run()
    assert [r.id for r in rows] == [1, 2, 3]
    assert rows[1]["at"] is None and all(r._rescued is None for r in rows)


def test_csv_cells_that_do_not_fit_are_rescued(spark, tmp_path):
    feed = Feed(spark, tmp_path, "csv")
    drop_file(feed.landing, "a.csv", "id,q,at\n1,many,never\n2,6,2026-01-01 00:00:00,extra\n3,7\n")
    rows = feed.run()
    assert json.loads(rows[0]._rescued) == {"q": "many", "at": "never"}
    assert rows[0].q is None
    assert json.loads(rows[1]._rescued) == {"_corrupt_record": "2,6,2026-01-01 00:00:00,extra"}
    assert rows[1].q == 6
    assert "_corrupt_record" in rows[2]._rescued and rows[2].q == 7


def test_json_lines_are_rescued(spark, tmp_path):
    feed = Feed(spark, tmp_path, "json")
    lines = [
        '{"id": 1, "q": 5, "at": "2026-01-01 00:00:00"}',
        '{"id": 2, "q": "5.5", "color": "red", "deep": {"a": [1]}}',
        "{broken",
        "",
        '{"q": null, "id": 4}',
    ]
    drop_file(feed.landing, "a.json", "\n".join(lines) + "\n")
    rows = {r.id: r for r in feed.run()}
    assert len(rows) == 4
    assert rows[1].q == 5 and rows[1]._rescued is None
    assert json.loads(rows[2]._rescued) == {"q": "5.5", "color": "red", "deep": '{"a":[1]}'}
    assert json.loads(rows[None]._rescued) == {"_corrupt_record": "{broken"}
    assert rows[4].q is None and rows[4]._rescued is None


def test_a_reordered_header_stops_the_stream(spark, tmp_path):
    feed = Feed(spark, tmp_path, "csv")
    drop_file(feed.landing, "a.csv", "q,id,at\n5,1,\n")
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        feed.run()


class Deliveries:
    """A landing folder and the bronze folder fed from it, with a registered schema."""

    def __init__(self, spark, root, file_format, schema=SMALL):
        self.spark, self.root, self.format = spark, root, file_format
        self.landing = root / "landing"
        self.landing.mkdir(parents=True, exist_ok=True)
        self.registry = SchemaRegistry(spark, str(root / "schemas"))
        self.registry.save("d", schema)

    def run(self):
        paths = [str(self.root / n) for n in ("landing", "bronze", "checkpoint")]
        load_bronze(self.spark, "d", self.format, *paths, self.registry)
        return {r.id: r for r in self.rows().collect()}

    def rows(self):
        schema = bronze_schema(self.registry.load("d").schema)
        return read_batches(self.spark, str(self.root / "bronze"), schema)


def test_files_are_placed_by_name(spark, tmp_path):
    feed = Deliveries(spark, tmp_path, "csv")
    assert feed.run() == {}
    drop_file(feed.landing, "a.csv", "id,q,at\n1,5,\n")
    drop_file(feed.landing, "b.csv", "\ufeffq,at,id\n6,2026-01-01 00:00:00,2\n\n")
    drop_file(feed.landing, "c.csv", 'id,q,"x"\n3,bad,hey\n')
    rows = feed.run()
    assert (rows[1].q, rows[2].q, rows[3].q) == (5, 6, None)
    assert rows[2]["at"] is not None and rows[1]._rescued is None
    assert rows[3].x == "hey" and json.loads(rows[3]._rescued) == {"q": "bad"}
    assert rows[3]._source_file.endswith("c.csv")
    assert len(feed.run()) == 3
    drop_file(feed.landing, "d.csv", "id,q,at\n4,8,\n")
    drop_file(feed.landing, "e.csv", "z,id\n1.5,5\n")
    rows = feed.run()
    assert feed.rows().columns == ["id", "q", "at", "x", "z", "_rescued", "_source_file"]
    assert feed.rows().count() == 5
    assert {i: r.z for i, r in rows.items()} == {1: None, 2: None, 3: None, 4: None, 5: 1.5}


def test_repeated_and_missing_names_are_rescued(spark, tmp_path):
    feed = Deliveries(spark, tmp_path, "csv")
    drop_file(feed.landing, "a.csv", "id,q,id,,q\n1,5,7,x,\n")
    rows = feed.run()
    assert feed.rows().columns == ["id", "q", "at", "_rescued", "_source_file"]
    assert rows[1].q == 5 and json.loads(rows[1]._rescued) == {"id#3": "7", "#4": "x"}


def test_lines_that_do_not_fit_their_header(spark, tmp_path):
    feed = Deliveries(spark, tmp_path, "csv")
    text = 'id,q,at\n1,many,never\n2,6,2026-01-01 00:00:00,extra\n3,7\n"4",8,"2026-01-01 00:00:00"\n'
    drop_file(feed.landing, "a.csv", text)
    rows = feed.run()
    assert json.loads(rows[1]._rescued) == {"q": "many", "at": "never"}
    assert json.loads(rows[2]._rescued) == {"_corrupt_record": "2,6,2026-01-01 00:00:00,extra"}
    assert rows[2].q == 6 and rows[3].q == 7 and "_corrupt_record" in rows[3]._rescued
    assert rows[4]._rescued is None and rows[4]["at"] is not None


def test_the_header_is_the_first_line_of_each_file(spark, tmp_path):
    feed = Deliveries(spark, tmp_path, "csv")
    drop_file(feed.landing, "a.csv", "id,q,at\n" + "".join(f"{i},2,\n" for i in range(20_000)))
    drop_file(feed.landing, "b.csv", "q,id,at\n" + "".join(f"3,{i},\n" for i in range(20_000, 40_000)))
    # Small splits and few partitions: a file lies in several, and a partition has several files.
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        feed.run()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
    got = feed.rows().groupBy("q").agg(F.count("*"), F.min("id"), F.max("id")).collect()
    assert sorted(map(tuple, got)) == [(2, 20_000, 0, 19_999), (3, 20_000, 20_000, 39_999)]


def test_lines_equal_to_the_header_are_data_but_for_one(spark, tmp_path):
    feed = Deliveries(spark, tmp_path, "csv")
    drop_file(feed.landing, "a.csv", "\nid,q,at\n1,5,\nid,q,at\nid,q,at\n")
    drop_file(feed.landing, "b.csv", "at,id,q,new\n,2,6,x\n,3,7\n")
    feed.run()
    rows = sorted(((r.id, r.q, r.new, r._rescued) for r in feed.rows().collect()), key=str)
    again = '{"id":"id","q":"q","at":"at"}'
    assert [r[:3] for r in rows] == [(1, 5, None), (2, 6, "x"), (3, 7, None), (None, None, None), (None, None, None)]
    assert [r[3] for r in rows] == [None, None, '{"_corrupt_record":",3,7"}', again, again]


def test_known_columns_are_not_typed_again_and_lines_not_shuffled(spark, tmp_path, monkeypatch):
    def typed(*args, **kwargs):
        raise AssertionError("no header has a new name")

    monkeypatch.setattr(deliveries, "infer_fields", typed)
    feed = Deliveries(spark, tmp_path, "csv")
    drop_file(feed.landing, "a.csv", "id,q,at\n1,5,\n")
    drop_file(feed.landing, "b.csv", "q,at,id\n6,,2\n")
    assert sorted(feed.run()) == [1, 2]
    lines = spark.read.text(str(feed.landing)).select(
        "value", F.col("_metadata.file_path").alias("_source_file"), F.lit(True).alias("__first_split")
    )
    plan = deliveries._CsvRows(lines).lines._jdf.queryExecution().executedPlan().toString()
    main, repeated = plan.split("HashAggregate", 1)
    assert "BroadcastHashJoin" in main and "hashpartitioning" not in main and "hashpartitioning" in repeated


def test_new_json_fields_join_the_schema(spark, tmp_path):
    feed = Deliveries(spark, tmp_path, "json")
    drop_file(feed.landing, "a.json", '{"id": 1, "q": 5}\n{broken\n')
    assert json.loads(feed.run()[None]._rescued) == {"_corrupt_record": "{broken"}
    lines = ['{"id": 2, "zip": "0123", "n": 7, "deep": {"a": [1, 2]}, "we, ird": 1.5, "ok": true}', '{"id": 3, "n": null}']
    drop_file(feed.landing, "b.json", "\n".join(lines))
    rows = feed.run()
    learnt = {f.name: f.dataType.simpleString() for f in feed.registry.load("d").schema.fields[3:]}
    assert learnt == {"deep": "string", "n": "bigint", "ok": "boolean", "we, ird": "double", "zip": "string"}
    assert rows[2].zip == "0123" and rows[2].n == 7 and rows[2].deep == '{"a":[1,2]}' and rows[2].ok
    assert rows[1].zip is None and rows[2]._rescued is None


def test_more_new_names_than_a_table_has_are_rescued(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(deliveries, "MAX_NEW_COLUMNS", 3)
    for file_format, line in (("csv", "id,a,b,c,e\n1,2,3,4,5\n"), ("json", '{"id":1,"a":2,"b":3,"c":4,"e":5}')):
        feed = Deliveries(spark, tmp_path / file_format, file_format)
        drop_file(feed.landing, "a", line)
        row = feed.run()[1]
        assert feed.rows().columns == ["id", "q", "at", "_rescued", "_source_file"]
        assert json.loads(row._rescued) == {"a": "2", "b": "3", "c": "4", "e": "5"}


def test_a_batch_that_died_is_written_again(spark, tmp_path, monkeypatch):
    feed = Deliveries(spark, tmp_path, "csv")
    drop_file(feed.landing, "a.csv", "id,q,at\n1,5,\n2,6,\n")
    real = deliveries.batch_folder

    def dies(root, number):
        # What a run leaves that died half-way: rows in the folder, the batch not committed.
        half = spark.sql("select 1L id, 5 q, cast(null as timestamp) at, '' _rescued, '' _source_file")
        half.write.mode("overwrite").parquet(real(root, number))
        raise RuntimeError("died")

    with monkeypatch.context() as patch:
        patch.setattr(deliveries, "batch_folder", dies)
        with pytest.raises(Exception, match="died"):
            feed.run()
    assert sorted(feed.run()) == [1, 2] and feed.rows().count() == 2


def test_inference_and_evolution(spark, tmp_path):
    drop_file(tmp_path / "c", "a.csv", "id,price,at,name\n1,2.5,2026-01-01 00:00:00,x\n")
    seen = infer_schema(spark, str(tmp_path / "c"), "csv")
    assert seen.simpleString() == "struct<id:int,price:double,at:timestamp,name:string>"
    grown = evolve(StructType.fromDDL("id bigint, name string"), seen)
    assert grown.simpleString() == "struct<id:bigint,name:string,price:double,at:timestamp>"
    drop_file(tmp_path / "j", "a.json", '{"id": 1, "ok": true}\n')
    assert infer_schema(spark, str(tmp_path / "j"), "json").simpleString() == "struct<id:bigint,ok:boolean>"
    with pytest.raises(ValueError):
        infer_schema(spark, str(tmp_path / "j"), "xml")
    drop_file(tmp_path / "t", "a.csv", "a,b,c,d,e,f,g\n1,3000000000,1e3,2026-01-01,true,,x\n,2,.5,2026-01-01T01:02:03,FALSE,,7\n")
    kinds = "struct<a:int,b:bigint,c:double,d:timestamp,e:boolean,f:string,g:string>"
    assert infer_schema(spark, str(tmp_path / "t"), "csv").simpleString() == kinds


def test_csv_columns_are_typed_by_one_aggregate(spark, tmp_path, monkeypatch):
    from opslake.sources import schemas

    real, seen = schemas.infer_fields, []
    monkeypatch.setattr(schemas, "infer_fields", lambda entries: seen.append(entries.columns) or real(entries))
    drop_file(tmp_path / "c", "a.csv", "b,a.x,c,d,e\n+5,2024,x,,2024-13-01\n 7 ,3.0,NaN,,2024-01-01\n,,,,\n")
    found = infer_schema(spark, str(tmp_path / "c"), "csv")
    assert found.simpleString() == "struct<b:int,a.x:double,c:string,d:string,e:string>"
    assert seen == [["name", "value"]]  # rows, however many columns there are
    drop_file(tmp_path / "h", "a.csv", "b,a\n")
    assert infer_schema(spark, str(tmp_path / "h"), "csv").simpleString() == "struct<b:string,a:string>"


def test_registry_versions(spark, tmp_path):
    registry = SchemaRegistry(spark, str(tmp_path / "r"))
    assert registry.load("d") is None
    first = registry.save("d", SMALL)
    assert registry.save("d", SMALL) == first
    second = registry.evolve("d", StructType.fromDDL("extra string, q double"))
    assert second.version == 2 and second.schema.names == ["id", "q", "at", "extra"]
    assert second.schema["q"].dataType.simpleString() == "int"
    assert registry.load("d", 1).schema == SMALL
    assert registry.save("d", second.schema, generation=1).generation == 1
    assert registry.load("other") is None


def test_new_column_on_the_same_checkpoint(spark, tmp_path):
    feed = Feed(spark, tmp_path, "json")
    drop_file(feed.landing, "a.json", '{"id": 1, "q": 5}\n')
    feed.run()
    feed.schema = StructType.fromDDL("id bigint, q int, at timestamp, color string")
    drop_file(feed.landing, "b.json", '{"id": 2, "q": 6, "color": "red"}\n')
    assert [(r.id, r.color) for r in feed.run()] == [(1, None), (2, "red")]


def test_stream_of_a_table_equals_a_batch(spark, sf, tmp_path):
    spec = DATASETS["work_orders"]
    raw = RAW["work_orders"](spark, sf)
    early = F.col("work_order_id") < 700
    want = spec.silver(raw)
    for name, part in (("a", raw.filter(early)), ("b", raw.filter(~early))):
        write_shards(part, str(tmp_path / "landing" / name), "csv", 2, spec.key)
        feed = ingest_stream(spark, str(tmp_path / "landing"), "csv", spec.landing_schema)
        write_stream(feed, str(tmp_path / "bronze"), str(tmp_path / "c1"))
        bronze = stream_table(spark, str(tmp_path / "bronze"), bronze_schema(spec.landing_schema))
        write_stream(spec.silver(bronze), str(tmp_path / "silver"), str(tmp_path / "c2"))
    got = read_table(spark, str(tmp_path / "silver"), want.schema)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_counts_cover_every_micro_batch(spark, sf, tmp_path):
    spec = DATASETS["purchases"]
    raw = RAW["purchases"](spark, sf)
    write_shards(raw, str(tmp_path / "landing"), "csv", 6, spec.key)
    feed = ingest_stream(
        spark, str(tmp_path / "landing"), "csv", spec.landing_schema, max_bytes_per_trigger="120000"
    )
    checked = apply_expectations(spec.project(feed), spec.expectations, "dq")
    batches = write_stream(checked, str(tmp_path / "silver"), str(tmp_path / "checkpoint"))
    assert len(batches) > 1
    log = event_log_rows(spark, "r", "purchases", spec.expectations, batches).collect()
    bad = {
        "qty_positive": raw.filter("qty <= 0").count(),
        "unit_price_positive": raw.filter("unit_price_usd <= 0").count(),
        "discount_in_range": raw.filter("discount_pct not between 0 and 1").count(),
    }
    assert all(bad.values())
    assert {r.expectation: (r.passed + r.failed, r.failed) for r in log} == {
        name: (raw.count(), n) for name, n in bad.items()
    }
    assert read_table(spark, str(tmp_path / "silver"), checked.schema).count() == raw.count() - bad["qty_positive"]


@pytest.mark.parametrize("file_format", ["csv", "json"])
def test_shards_hold_contiguous_ranges(spark, tmp_path, file_format):
    path = str(tmp_path / "s")
    write_shards(spark.range(1000).selectExpr("id", "id * 2 AS twice"), path, file_format, 4, "id")
    reader = spark.read.schema("id bigint, twice bigint").option("header", True)
    rows = getattr(reader, file_format)(path).select("id", F.input_file_name().alias("f"))
    ranges = sorted(
        (r.low, r.high, r.n)
        for r in rows.groupBy("f").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count("*").alias("n")).collect()
    )
    assert len(ranges) == 4 and sum(n for *_, n in ranges) == 1000
    assert all(high - low + 1 == n for low, high, n in ranges)
    assert all(a[1] + 1 == b[0] for a, b in zip(ranges, ranges[1:]))


@pytest.mark.parametrize("rows", [0, 1, 4, 5, 11, 103])
def test_shards_are_of_equal_size(spark, tmp_path, rows):
    path = str(tmp_path / "s")
    # A third of the rows share a key, and the input lies in uneven partitions.
    df = spark.range(rows, numPartitions=3).selectExpr("if(id % 3 = 0, 5L, id) AS id", "id AS v")
    write_shards(df, path, "json", 4, "id")
    files = spark.read.schema("id bigint, v bigint").json(path).withColumn("f", F.input_file_name())
    sizes = [r["count"] for r in files.groupBy("f").count().orderBy("f").collect()]
    per_shard = -(-rows // 4)
    want = [min(per_shard, rows - at) for at in range(0, rows, max(1, per_shard))]
    assert sizes == want
    bounds = files.groupBy("f").agg(F.min("id").alias("low"), F.max("id").alias("high")).orderBy("f").collect()
    assert all(a.high <= b.low for a, b in zip(bounds, bounds[1:]))
    assert sorted(r.v for r in files.collect()) == list(range(rows))
    with pytest.raises(ValueError):
        write_shards(df, str(tmp_path / "x"), "xml", 1, "id")


def test_the_event_log_counts_each_batch_once(spark, sf, tmp_path, monkeypatch):
    spec, raw = DATASETS["purchases"], RAW["purchases"](spark, sf)

    def logged(house):
        rows = house.event_log().filter("expectation = 'qty_positive'").groupBy().sum("passed", "failed").head()
        return tuple(rows)

    def counted(rows):
        bad = rows.filter("qty <= 0").count()
        return rows.count() - bad, bad

    landing = tmp_path / "landing"
    early = F.col("purchase_id") % 3 != 0
    write_shards(raw.filter(early), str(landing / "purchases" / "a"), "csv", 6, spec.key)
    house = Lakehouse(spark, str(tmp_path / "tables"), str(landing), max_bytes_per_trigger="20000")
    silver = house.refresh_dataset("purchases", register=False)
    batches = list((tmp_path / "tables" / "_event_log").rglob("batch-*"))
    assert len([b for b in batches if b.is_dir()]) > 1
    assert logged(house) == counted(raw.filter(early))
    write_shards(raw.filter(~early), str(landing / "purchases" / "b"), "csv", 2, spec.key)

    # A driver that dies after a batch's rows and before its counts: the batch comes again.
    def dies(*args):
        raise RuntimeError("died")

    with monkeypatch.context() as patch:
        patch.setattr(deliveries, "event_log_rows", dies)
        with pytest.raises(Exception, match="died"):
            house.refresh_dataset("purchases", register=False)
    # Neither this run nor the next reads a bronze file of the first delivery.
    for path in (tmp_path / "tables" / "suppliers" / "bronze_purchases").rglob("batch-0*"):
        if path.is_dir() and "batch-00000000" in str(path):
            path.rename(path.with_name("_put-away"))
    house.refresh_dataset("purchases", register=False)
    assert logged(house) == counted(raw)
    assert silver.sparkSession.read.schema(silver.schema).option("recursiveFileLookup", True).parquet(
        str(tmp_path / "tables" / "suppliers" / "silver_purchases")
    ).count() == counted(raw)[0]
    house.refresh_dataset("purchases", register=False)
    assert logged(house) == counted(raw)


def test_shards_and_inference_leave_nothing_but_their_result(spark, tmp_path):
    """Ordered rows, shuffles and inferred text are deleted as soon as they are not needed."""
    from pathlib import Path

    from opslake.checks import QUERIES
    from opslake.session import scratch_path
    from opslake.sources.test_tables import COLUMNS

    scratch = Path(scratch_path(spark, "x")).parent
    kept = lambda: {p for p in scratch.glob("*") if p.name.startswith(("shard-order", "infer"))} if scratch.exists() else set()
    before, key = kept(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key)
    day = datetime(2024, 5, 1)
    rows = [(i, i, 1, 1 + i % 3, 10.0, 15.0 * i, 0.0, 0.0, "N", "O", day) for i in range(40)] * 2
    spark.createDataFrame(rows, COLUMNS["lineitem"]).write.parquet(str(tmp_path / "lineitem.parquet"))
    found = {(r.file_format, r.column_name): r.data_type for r in QUERIES["infer_schema"](spark, str(tmp_path)).collect()}
    assert found["csv", "small_id"] == "int" and found["json", "small_id"] == "bigint" and len(found) == 15
    left = kept() - before
    assert not [p for p in left if p.name.startswith("shard-order")]
    assert not [f for p in left for f in p.rglob("part-*")]
    assert spark.conf.get(key) == was
