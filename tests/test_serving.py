"""Snapshots, catalog, governance, embedding and search."""

import threading

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from opslake.operators import governance, search
from opslake.operators.diff import apply_diff, snapshot_diff
from opslake.operators.embedding import ModelEmbedder, TfIdfEmbedder, sync_index
from opslake.sources.catalog import NAMESPACES, create_namespaces, materialize, table_properties, tag_table


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_diff_and_its_application(spark):
    ddl = "k bigint, a string, b int"
    old = spark.createDataFrame([(1, "x", 1), (2, None, 2), (3, "gone", 3)], ddl)
    new = spark.createDataFrame([(1, "y", 1), (2, None, 2), (4, "new", None)], ddl)
    changes = snapshot_diff(old, new, "k")
    assert sorted(map(tuple, changes.collect())) == [
        ("delete", 3, "gone", 3),
        ("insert", 4, "new", None),
        ("update", 1, "y", 1),
    ]
    assert same(apply_diff(old, changes, "k"), new)
    assert snapshot_diff(old, new, "k", compare=["b"]).filter("change = 'update'").count() == 0
    assert snapshot_diff(new, new, "k").count() == 0


def test_diff_over_two_keys(spark):
    old = spark.createDataFrame([(1, "a", 5), (1, "b", 6)], "k int, w string, q int")
    new = spark.createDataFrame([(1, "a", 5), (1, "b", 7)], "k int, w string, q int")
    assert [tuple(r) for r in snapshot_diff(old, new, ["k", "w"]).collect()] == [("update", 1, "b", 7)]


def test_rows_without_a_key_are_replaced(spark):
    ddl = "k bigint, a string"
    old = spark.createDataFrame([(1, "x"), (None, "p"), (None, "q")], ddl)
    new = spark.createDataFrame([(1, "x"), (None, "q"), (2, "y")], ddl)
    changes = snapshot_diff(old, new, "k")
    assert sorted((r.change, r.a) for r in changes.collect()) == [
        ("delete", "p"),
        ("delete", "q"),
        ("insert", "q"),
        ("insert", "y"),
    ]
    assert same(apply_diff(old, changes, "k"), new)


def test_namespaces_and_materialized_tables(spark, tmp_path):
    create_namespaces(spark)
    create_namespaces(spark)
    assert set(NAMESPACES) <= {d.name for d in spark.catalog.listDatabases()}
    root = str(tmp_path / "root")
    first = materialize(spark.range(3), "raw.numbers", root, "Some numbers", {"layer": "gold"})
    assert first.count() == 3
    again = materialize(first.union(first), "raw.numbers", root)  # reads what it replaces
    assert again.count() == 6 and spark.table("raw.numbers").count() == 6
    broken = spark.range(3).select(F.raise_error(F.lit("stop")).cast("bigint").alias("id"))
    with pytest.raises(PySparkException):
        materialize(broken, "raw.numbers", root)
    assert spark.table("raw.numbers").count() == 6
    assert spark.catalog.getTable("raw.numbers").description == "Some numbers"
    assert table_properties(spark, "raw.numbers")["layer"] == "gold"
    wider = materialize(spark.range(2).withColumn("x", F.lit("a")), "raw.numbers", root)
    assert wider.columns == ["id", "x"]


def test_tags_survive_and_are_listed(spark, tmp_path):
    create_namespaces(spark)
    tags = {"id": {"pii": "true", "classification": "restricted"}}
    df = governance.tag_columns(spark.range(2), tags)
    materialize(df, "raw.tagged", str(tmp_path / "root"))
    tag_table(spark, "raw.tagged", {"certified": "false"})
    tag_table(spark, "raw.tagged", {"certified": "true"})
    listed = {tuple(r) for r in governance.tag_inventory(spark, ["raw.tagged"]).collect()}
    assert listed == {
        ("raw.tagged", None, "certified", "true"),
        ("raw.tagged", "id", "pii", "true"),
        ("raw.tagged", "id", "classification", "restricted"),
    }


def test_masked_view(spark):
    df = spark.createDataFrame([("12-3456789", 1)], "tax_id string, n int")
    masks = {"tax_id": "mask_tax_id"}
    assert governance.masked_view(df, masks).head().tax_id == "***-*6789"
    assert governance.masked_view(df, masks, ["others"]).head().tax_id == "***-*6789"
    assert governance.masked_view(df, masks, [governance.PII_VIEWERS]).head().tax_id == "12-3456789"
    with pytest.raises(KeyError):
        governance.masked_view(df, {"ssn": "mask_ssn"})


def test_a_published_mask_lasts_and_asks_who_reads(spark, tmp_path):
    create_namespaces(spark)
    people = spark.createDataFrame([("12-3456789", "a@b.c", 1), (None, "nobody", 2)], "tax_id string, mail string, n int")
    materialize(people, "raw.people", str(tmp_path / "root"))
    view = governance.publish_masked_view(spark, "raw.people", {"tax_id": "mask_tax_id", "mail": "mask_email"})
    assert view == "raw.people_masked"
    masked = [("***-*6789", "***@b.c", 1), (None, None, 2)]

    def seen():
        return sorted(map(tuple, spark.newSession().table(view).collect()), key=lambda r: r[2])

    assert seen() == masked
    governance.add_viewer(spark, "somebody else")
    assert seen() == masked
    wider = people.withColumn("n", F.col("n") * 1)
    materialize(wider, "raw.people", str(tmp_path / "root"))  # the view follows its table
    assert seen() == masked
    me = spark.sql("select current_user()").head()[0]
    governance.add_viewer(spark, me)
    plain = [("12-3456789", "a@b.c", 1), (None, "nobody", 2)]
    assert seen() == plain
    spark.sql(f"DROP TABLE {governance.VIEWERS}")  # as if the catalog had been kept in memory
    governance.create_viewers(spark)
    assert seen() == plain
    governance.remove_viewer(spark, me)
    assert seen() == masked and spark.table(governance.VIEWERS).count() == 1
    with pytest.raises(KeyError):
        governance.publish_masked_view(spark, "raw.people", {"ssn": "mask_ssn"})


def test_readers_are_never_without_a_table(spark, tmp_path):
    create_namespaces(spark)
    root = str(tmp_path / "root")
    materialize(spark.range(5), "raw.moving", root)
    stop, seen, failed = threading.Event(), [], []

    def read():
        while not stop.is_set():
            try:
                seen.append(spark.table("raw.moving").count())
            except Exception as e:  # the point of the test
                failed.append(str(e)[:300])

    readers = [threading.Thread(target=read) for _ in range(2)]
    for r in readers:
        r.start()
    for i in range(6):
        wider = spark.range(5).select("id", *(F.lit(i).alias(f"x{j}") for j in range(i + 1)))
        assert materialize(wider, "raw.moving", root, properties={"step": str(i)}).columns == wider.columns
        materialize(wider, "raw.moving", root)
    stop.set()
    for r in readers:
        r.join()
    assert failed == [] and len(seen) > 5 and set(seen) == {5}
    assert table_properties(spark, "raw.moving")["step"] == "5"
    files = [t.name for t in spark.catalog.listTables("raw") if t.name.startswith("moving__")]
    assert len(files) == 2


def test_metric_states_roll_up_to_any_grain(spark, tmp_path):
    from opslake.operators.metric_view import MetricView

    create_namespaces(spark)
    rows = spark.range(3000).selectExpr(
        "case when id % 11 = 0 then null else id % 3 end as a", "id % 5 as b", "id % 7 as c",
        "case when id % 13 = 0 then null else (id * 7919) % 70000 end as who", "id / 8 as x",
        "case when id % 5 = 2 then null else id / 4 end as y",
    )
    measures = {
        "total": "SUM(x * 2)", "mean": "AVG(y)", "n": "COUNT(*)", "present": "COUNT(y)", "people": "COUNT(DISTINCT who)"
    }
    view = MetricView("mv_any", "raw.nothing", {"a": "a", "b": "b", "c": "c + 1"}, measures)
    assert view.publish(spark, "business_metrics", str(tmp_path / "m"), rows) == "business_metrics.mv_any"

    def content(df):
        return sorted(map(tuple, df.collect()), key=repr)

    for dims in ([], ["a"], ["b"], ["c", "a"], ["a", "b", "c"]):
        for wanted in (None, ["people"], ["mean", "n"]):
            want = view.query(rows, dims, wanted)
            got = view.rollup(spark, "business_metrics", dims, wanted)
            assert got.columns == want.columns and content(got) == content(want)
    filtered = view.rollup(spark, "business_metrics", ["b"], where="a = 1")
    assert content(filtered) == content(view.query(rows, ["b"], where="a = 1"))
    assert content(view.rollup(spark, "business_metrics", where="a = 9")) == content(view.query(rows, where="a = 9"))
    finest = spark.newSession().table("business_metrics.mv_any")
    assert content(finest) == content(view.query(rows, ["a", "b", "c"]))
    # What is stored is less than the rows, and plain SQL does the rest.
    states = spark.table("business_metrics.mv_any_states")
    assert states.count() < rows.count()
    with pytest.raises(ValueError):
        MetricView("bad", "t", {"a": "a"}, {"m": "MAX(x)"}).states(rows)
    with pytest.raises(ValueError):
        MetricView("bad", "t", {"a": "a"}, {"m": "COUNT(DISTINCT b)", "k": "COUNT(DISTINCT c)"}).states(rows)


# --- search ----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(7)
    rows = rng.normal(size=(600, 16)).astype(np.float32)
    rows[200:400] = rows[5]  # a third of the index are copies of one vector
    rows[450] = 0
    return rows


@pytest.fixture(scope="module")
def index(spark, vectors):
    rows = [(int(i), f"name {i}", [float(x) for x in v]) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "part_id bigint, name string, embedding array<float>")
    return df.union(spark.createDataFrame([(9999, "none", None)], df.schema)).repartition(7).cache()


def brute_force(vectors, queries, k):
    def unit(m):
        m = m.astype(np.float64)
        n = np.linalg.norm(m, axis=1, keepdims=True)
        return np.divide(m, n, out=np.zeros_like(m), where=n > 0)

    scores = np.round(unit(queries) @ unit(vectors).T, 9)
    return {
        q: [(int(i), float(row[i])) for i in sorted(range(len(row)), key=lambda i: (-row[i], i))[:k]]
        for q, row in enumerate(scores)
    }


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.part_id, r.score))
    return out


def ask(spark, vectors):
    rows = [(int(i), [float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "query_id int, embedding array<float>")


def test_exact_search_equals_brute_force(spark, index, vectors):
    queries = vectors[[0, 5, 250, 450]]
    got = search.search(index, ask(spark, queries), 5, ["name"])
    assert got.columns == ["query_id", "rank", "part_id", "name", "score"]
    assert found(got) == brute_force(vectors, queries, 5)
    assert all(r.name == f"name {r.part_id}" for r in got.collect())


def test_blocks_of_queries_scan_the_index_where_it_lies(spark, index, vectors, monkeypatch):
    queries = vectors[::10]
    got = search.search(index, ask(spark, queries), 4, ["name"], block_queries=13)
    assert found(got) == brute_force(vectors, queries, 4)
    # The scans are put together; no index row meets a query through a join.
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") > 2
    assert "Join" not in plan and "CoGroup" not in plan
    monkeypatch.setattr(search, "BLOCK_BYTES", 8 * len(queries[0]) * 7)
    bound = search.search(index, ask(spark, queries), 4, ["name"])
    assert found(bound) == brute_force(vectors, queries, 4)


def test_search_edges(spark, index, vectors):
    nothing = search.search(index, ask(spark, vectors[:0]), 5)
    assert nothing.count() == 0 and nothing.columns == ["query_id", "rank", "part_id", "score"]
    few = search.search(index.filter("part_id < 3"), ask(spark, vectors[:2]), 5)
    assert few.count() == 6
    mixed = spark.createDataFrame([(1, "a", [1.0]), (2, "b", [1.0, 2.0])], index.schema)
    with pytest.raises(Exception, match="widths"):
        search.search(mixed, ask(spark, np.ones((1, 1))), 1).collect()


def test_lsh_recall_on_the_test_vectors(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    queries = df.select(F.col("vec_id").alias("query_id"), "embedding")
    lsh = search.LshBuckets.fit(df)
    exact = search.search(df, queries, 5, key="vec_id").select("query_id", "vec_id")
    near = search.search_approx(lsh.assign(df), queries, lsh, 5, key="vec_id")
    assert near.groupBy("query_id").count().filter("count <> 5").count() == 0
    recall = near.select("query_id", "vec_id").intersect(exact).count() / exact.count()
    assert recall >= 0.9


def test_a_query_without_an_id_costs_no_other_its_results(spark, index, vectors):
    lsh = search.LshBuckets.fit(index.filter("embedding is not null"))
    asked = ask(spark, vectors[[3, 5]])
    nameless = asked.limit(1).withColumn("query_id", F.lit(None).cast(asked.schema["query_id"].dataType))
    got = found(search.search_approx(lsh.assign(index), asked.unionByName(nameless), lsh, 5))
    assert len(got) == len(brute_force(vectors, vectors[[3, 5]], 5))


def test_lsh_falls_back_to_exact_for_lonely_queries(spark, index, vectors):
    lsh = search.LshBuckets.fit(index.filter("embedding is not null"), bucket_length=0.0005, tables=1)
    queries = vectors[[3, 5]] * 40
    got = found(search.search_approx(lsh.assign(index), ask(spark, queries), lsh, 5))
    assert got == brute_force(vectors, queries, 5)


def test_equal_queries_spread_over_blocks(spark, index, vectors, monkeypatch):
    equal = ask(spark, vectors[[3]]).crossJoin(spark.range(60).select(F.col("id").alias("n")))
    equal = equal.select(F.col("n").cast("int").alias("query_id"), "embedding").repartition(3)
    monkeypatch.setattr(search, "BLOCK_BYTES", 8 * vectors.shape[1] * 7)
    sizes = [b.num_rows for b in search._query_blocks(equal, 1000)]
    assert sum(sizes) == 60 and max(sizes) == 7 and len(sizes) == 9
    got = found(search.search(index, equal, 3))
    assert len(got) == 60 and all(v == brute_force(vectors, vectors[[3]], 3)[0] for v in got.values())


def test_cells_reach_their_recall_and_skip_files(spark, sf, tmp_path):
    from opslake.operators.cells import CellIndex
    from opslake.operators.embedding import HashedWordEmbedder
    from opslake.plans import parts
    from opslake.plans.domains import DATASETS
    from opslake.sources.test_tables import RAW

    catalogue = parts.parts_searchable(DATASETS["parts"].silver(RAW["parts"](spark, "/root/testdata/sf0.01")))
    rows = HashedWordEmbedder().transform(catalogue, "description").cache()
    index = CellIndex.build(rows, str(tmp_path), "part_id", cells=40)
    assert index.rows().count() == rows.count() and index.recall >= 0.9 and index.probes <= 20
    assert CellIndex(spark, index.path, "part_id").probes == index.probes
    asked = rows.where("part_id % 50 = 7").select(F.col("part_id").alias("query_id"), "embedding")
    exact = search.search(rows, asked, 5).select("query_id", "part_id")
    near = index.search(asked, 5)
    assert near.groupBy("query_id").count().where("count <> 5").count() == 0
    assert near.select("query_id", "part_id").intersect(exact).count() >= 0.9 * exact.count()

    one = asked.limit(1)
    block = next(search._query_blocks(one, 10))
    scan = index._scan(one, block, 5, ["part_id"], index.probes)
    kept = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        plan = scan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", kept)
    assert "PartitionFilters: [" in plan and "cell" in plan.split("PartitionFilters: [")[1].split("]")[0]
    cells = {f.split("cell=")[1].split("/")[0] for f in index.rows().inputFiles()}
    assert index.probes / len(cells) <= 0.5


def test_cells_are_bounded_listed_once_and_searched_in_one_scan(spark, index, vectors, tmp_path, monkeypatch):
    from opslake.operators import cells

    monkeypatch.setattr(cells, "MAX_CELLS", 7)
    found_in = cells.CellIndex.build(index, str(tmp_path), "part_id", recall=1.0)
    assert len(found_in.centres) <= 7 and found_in.rows() is found_in.rows()
    monkeypatch.setattr(search, "BLOCK_QUERIES", 2)  # per cell now; a block is bounded by its bytes
    scans, real = [], cells.CellIndex._scan
    monkeypatch.setattr(cells.CellIndex, "_scan", lambda *args: scans.append(1) or real(*args))
    queries = vectors[[0, 5, 250, 450, 7]]
    got = found(found_in.search(ask(spark, queries), 5, probes=len(found_in.centres)))
    assert got == brute_force(vectors, queries, 5) and len(scans) == 1


def test_cells_of_few_rows_and_none(spark, index, vectors, tmp_path):
    from opslake.operators.cells import CellIndex

    cells = CellIndex.build(index, str(tmp_path), "part_id", cells=30, recall=1.0)
    queries = vectors[[0, 5, 250, 450]]
    assert found(cells.search(ask(spark, queries), 5, probes=30)) == brute_force(vectors, queries, 5)
    few = found(cells.search(ask(spark, queries), 590, probes=1))  # more than a cell holds
    assert few == brute_force(vectors, queries, 590)
    assert cells.search(ask(spark, queries[:0]), 5).count() == 0
    empty = CellIndex.build(index.limit(0), str(tmp_path), "part_id")
    assert empty.search(ask(spark, queries), 5).count() == 0


# --- embedding and sync ----------------------------------------------------------------

TEXTS = [
    (1, "infusion pump tube"),
    (2, "ventilator filter"),
    (3, "pump filter"),
    (4, None),
]


def texts(spark, rows=TEXTS):
    return spark.createDataFrame(rows, "part_id bigint, description string")


def test_tfidf_finds_the_closest_text(spark, tmp_path):
    source = texts(spark)
    embedder = TfIdfEmbedder.fit(source, "description", width=128)
    index = sync_index(None, source, embedder, "part_id", "description")
    queries = spark.createDataFrame([(1, "a tube for infusion")], "query_id int, query_text string")
    best = search.search_text(index, queries, embedder, k=1, columns=["description"]).head()
    assert best.part_id == 1 and 0 < best.score <= 1
    embedder.save(str(tmp_path / "model"))
    loaded = TfIdfEmbedder.load(str(tmp_path / "model"))
    assert same(sync_index(None, source, loaded, "part_id", "description"), index)


def test_sync_embeds_only_what_changed(spark):
    old = ModelEmbedder(lambda batch: np.array([[len(t), 1.0] for t in batch]))
    new = ModelEmbedder(lambda batch: np.array([[len(t), 2.0] for t in batch]))
    index = sync_index(None, texts(spark), old, "part_id", "description")
    later = texts(spark, [(1, "infusion pump tube"), (2, "ventilator"), (5, "brand new")])
    synced = sync_index(index, later, new, "part_id", "description")
    got = {r.part_id: r.embedding for r in synced.collect()}
    assert got == {1: [18.0, 1.0], 2: [10.0, 2.0], 5: [9.0, 2.0]}

    def refuse(batch):
        raise AssertionError("nothing to embed")

    assert same(sync_index(synced, later, ModelEmbedder(refuse), "part_id", "description"), synced)


def test_sync_refreshes_other_columns_without_embedding(spark):
    embedder = ModelEmbedder(lambda batch: np.ones((len(batch), 2)))
    source = texts(spark, [(1, "a")]).withColumn("price", F.lit(1.0))
    index = sync_index(None, source, embedder, "part_id", "description")
    row = sync_index(index, source.withColumn("price", F.lit(2.0)), ModelEmbedder(None), "part_id", "description").head()
    assert row.price == 2.0 and row.embedding == [1.0, 1.0]


def test_sync_keeps_one_row_per_repeated_key(spark):
    embedder = ModelEmbedder(lambda batch: np.array([[len(t), 1.0] for t in batch]))
    source = texts(spark, [(1, "old"), (1, "newest"), (1, "old"), (2, "other"), (None, "lost")])
    index = sync_index(None, source, embedder, "part_id", "description")
    for _ in range(3):
        synced = sync_index(index, source, ModelEmbedder(None), "part_id", "description")
        assert synced is index and index.count() == 2
    assert {r.description for r in index.collect()} == {"old", "other"}
    changes = snapshot_diff(source, source.union(source), "part_id")
    assert changes.filter("part_id is not null").count() == 0
