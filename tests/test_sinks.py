"""Sinks and scans round trips in fresh folders under the shared root."""

import pytest
from pyspark.sql import functions as F

from critiq.session import local_path, scratch_path
from critiq.sources import (
    append_report,
    documents_path,
    read_documents,
    read_feed,
    read_feed_with_schema,
    read_partitioned_parquet,
    with_provenance,
    write_dated_parquet,
    write_documents,
    write_partitioned_parquet,
)

import os


def frame(spark, n, tag):
    return spark.createDataFrame([(i, tag) for i in range(n)], "k int, tag string")


def test_parquet_sink_replaces_only_its_day(spark):
    path = scratch_path(spark, "t_sink")
    assert write_partitioned_parquet(frame(spark, 3, "d1"), path, "20240101")
    assert write_partitioned_parquet(frame(spark, 2, "d2"), path, "20240102")
    assert write_partitioned_parquet(frame(spark, 5, "d1b"), path, "20240101")
    got = read_partitioned_parquet(spark, path).groupBy("odate", "tag").count().collect()
    assert sorted((r["odate"], r["tag"], r["count"]) for r in got) == [("20240101", "d1b", 5), ("20240102", "d2", 2)]


def test_parquet_sink_skips_empty(spark):
    path = scratch_path(spark, "t_empty")
    assert write_partitioned_parquet(frame(spark, 0, "x"), path, "20240101") is False
    assert not os.path.exists(local_path(path))


def test_parquet_sink_rejects_bad_input(spark):
    with pytest.raises(TypeError):
        write_partitioned_parquet("not a frame", "/x", "20240101")
    with pytest.raises(ValueError):
        write_partitioned_parquet(frame(spark, 1, "x"), "", "20240101")
    with pytest.raises(ValueError):
        write_partitioned_parquet(frame(spark, 1, "x"), scratch_path(spark, "t"), "2024-01-01")


def test_documents_sink_keeps_old_documents_when_empty(spark):
    path = scratch_path(spark, "t_docs")
    assert write_documents(spark.createDataFrame([("a", None)], "x string, y string"), path)
    assert write_documents(frame(spark, 0, "x"), path) is False
    lines = spark.read.text(documents_path(spark, path)).collect()
    assert [r[0] for r in lines] == ['{"x":"a"}']


def test_report_appends_and_refuses_incomplete_ones(spark):
    from critiq.plans.report import RunInfo, failure_report

    path, run = scratch_path(spark, "t_report"), RunInfo(application_id="a")
    append_report(failure_report(spark, "r1", run), path, "failure")
    append_report(failure_report(spark, ValueError("r2"), run), path, "failure")
    assert sorted(r["error"] for r in spark.read.json(path).collect()) == ["r1", "r2"]
    whole = failure_report(spark, "r3", run)
    for report, kind in ((whole, "other"), (whole, "success"), (whole.drop("error"), "failure"), (whole.limit(0), "failure"),
                         (whole.withColumn("error", F.lit(None).cast("string")), "failure")):
        with pytest.raises(ValueError):
            append_report(report, path, kind)
    for error in (None, ""):
        with pytest.raises(ValueError):
            failure_report(spark, error, run)
    assert spark.read.json(path).count() == 2


def test_feed_scan_prunes_load_dates_and_reads_provenance(spark):
    path = scratch_path(spark, "t_feed")
    df = spark.createDataFrame([("1", "20240101"), ("2", "20240102"), ("3", "20240103")], "id string, odate string")
    df.write.partitionBy("odate").parquet(path)
    scanned = read_feed(spark, path, odate_from="20240102", odate_to="20240102")
    assert [r["id"] for r in scanned.collect()] == ["2"]
    plan = scanned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(odate" in plan
    prov = with_provenance(read_feed(spark, path).drop("odate")).collect()
    assert sorted((r["id"], r["odate"]) for r in prov) == [("1", "20240101"), ("2", "20240102"), ("3", "20240103")]
    assert all(r["file_name"].endswith(".parquet") for r in prov)


def test_provenance_without_load_date_is_empty_text(spark):
    path = scratch_path(spark, "t_flat")
    frame(spark, 2, "x").write.parquet(path)
    assert {r["odate"] for r in with_provenance(read_feed(spark, path)).collect()} == {""}


def test_schema_scan_takes_app_from_path_and_drops_response(spark):
    from pyspark.sql import types as T

    root = scratch_path(spark, "t_schema")
    spark.createDataFrame([("1", "bank", "x")], "id string, app string, response string").write.partitionBy(
        "app"
    ).parquet(f"{root}/store")
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("response", T.StringType())])
    df = read_feed_with_schema(spark, schema, f"{root}/store", app_from_path=r"/store/app=([^/]*)/")
    row = df.select("id", "app").collect()[0]
    assert (row["id"], row["app"]) == ("1", "bank")
    assert "response" not in df.columns


def test_feed_scan_of_single_days_keeps_the_load_date_and_merges_schemas(spark):
    path = scratch_path(spark, "t_days")
    spark.createDataFrame([("1",)], "id string").write.parquet(f"{path}/odate=20240101")
    spark.createDataFrame([("2", "x")], "id string, extra string").write.parquet(f"{path}/odate=20240102")
    df = read_feed(spark, [f"{path}/odate=20240101", f"{path}/odate=20240102"], base_path=path, merge_schema=True)
    got = sorted((r["id"], str(r["odate"]), r["extra"]) for r in df.collect())
    assert got == [("1", "20240101", None), ("2", "20240102", "x")]


def test_schema_scan_with_the_original_layout(spark):
    from pyspark.sql import types as T

    from critiq.sources.feeds import STORE_A_APP_FROM_PATH

    root = scratch_path(spark, "t_layout")
    spark.createDataFrame([("1", "x")], "id string, response string").write.parquet(
        f"{root}/googlePlay/bank_app/odate=20250510"
    )
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("response", T.StringType())])
    df = read_feed_with_schema(spark, schema, f"{root}/googlePlay/*/*", app_from_path=STORE_A_APP_FROM_PATH)
    assert [(r["id"], r["app"]) for r in df.select("id", "app").collect()] == [("1", "bank_app")]


def test_failed_document_write_keeps_the_previous_documents(spark):
    path = scratch_path(spark, "t_docs_fail")
    assert write_documents(spark.createDataFrame([("old",)], "x string"), path)
    broken = spark.range(3).selectExpr("CASE WHEN id = 2 THEN raise_error('boom') ELSE 'new' END AS x")
    with pytest.raises(Exception):
        write_documents(broken, path, empty=False)
    assert [r[0] for r in spark.read.text(documents_path(spark, path)).collect()] == ['{"x":"old"}']
    assert len(versions_of(path)) == 1
    assert write_documents(spark.createDataFrame([("new",)], "x string"), path)
    assert [r[0] for r in spark.read.text(documents_path(spark, path)).collect()] == ['{"x":"new"}']


def versions_of(path):
    from critiq.session import local_path

    return sorted(n for n in os.listdir(local_path(path)) if n.startswith("v-"))


def test_failed_publish_keeps_the_previous_documents(spark, monkeypatch):
    from critiq.sources import versions

    path = scratch_path(spark, "t_swap_fail")
    assert write_documents(spark.createDataFrame([("old",)], "x string"), path)
    before = versions_of(path)

    def fails(*_):
        raise OSError("no rename today")

    monkeypatch.setattr(versions, "publish", fails)
    with pytest.raises(OSError):
        write_documents(spark.createDataFrame([("new",)], "x string"), path)
    monkeypatch.undo()
    assert [r[0] for r in spark.read.text(documents_path(spark, path)).collect()] == ['{"x":"old"}']
    assert versions_of(path) == before


def test_readers_find_a_whole_collection_during_swaps(spark):
    """A reader that loops while the collection is replaced sees every time one whole version, newer ones later."""
    import threading

    path = scratch_path(spark, "t_swap_loop")
    n_rows, n_swaps = 50, 8

    def docs(k):
        return spark.range(n_rows).selectExpr(f"{k} AS k", "id")

    write_documents(docs(0), path)
    seen, errors, done = [], [], threading.Event()

    def reader():
        while not done.is_set():
            try:
                rows = read_documents(spark, path, docs(0).schema).collect()
                assert len(rows) == n_rows and len({r["k"] for r in rows}) == 1
                seen.append(rows[0]["k"])
            except Exception as exc:  # noqa: BLE001 - shown below
                errors.append(exc)

    thread = threading.Thread(target=reader)
    thread.start()
    for k in range(1, n_swaps + 1):
        write_documents(docs(k), path)
    done.set()
    thread.join()
    assert not errors and seen == sorted(seen)
    assert len(versions_of(path)) == 2  # the current one and the one before
    with pytest.raises(FileNotFoundError):
        documents_path(spark, scratch_path(spark, "t_nothing"))


def test_two_publishers_collide(spark):
    from critiq.sources import versions

    path = scratch_path(spark, "t_conflict")
    assert versions.current(spark, path) == (0, None)
    assert versions.publish(spark, path, "one", 0) == 1
    with pytest.raises(versions.PublishConflict):
        versions.publish(spark, path, "two", 0)
    assert versions.publish(spark, path, "two", 1) == 2
    assert versions.current(spark, path) == (2, "two")


def test_a_replayed_report_leaves_one_document(spark):
    from critiq.plans.report import RunInfo, failure_report

    path = scratch_path(spark, "t_replay")
    for app, day, error in (("a", "20240101", "first"), ("a", "20240101", "again"), ("a", "20240102", "x"), ("b", "20240101", "y")):
        append_report(failure_report(spark, error, RunInfo(application_id=app)), path, "failure", run_key=f"{app}:{day}")
    append_report(failure_report(spark, "no key", RunInfo(application_id="c")), path, "failure")
    assert sorted(r["error"] for r in spark.read.json(path).collect()) == ["again", "no key", "x", "y"]


def test_files_have_the_advisory_size_whatever_the_skew(spark):
    """A date that holds most rows is cut into several files, small ones are one file each, and no file but
    a date's last is under half of the advisory size."""
    from critiq.session import local_path

    path = scratch_path(spark, "t_sized")
    advisory = 1 << 20
    # bytes that do not compress, nine tenths of the rows on one date
    text = "concat_ws('', transform(sequence(1, 8), x -> sha2(cast(id * 10 + x as string), 512)))"
    days = "CASE WHEN id % 10 > 0 THEN '20240101' ELSE concat('2024010', cast(2 + id % 7 as string)) END AS odate"
    rows = spark.range(0, 20_000, 1, 40).selectExpr("id", f"{text} AS text", days)
    saved = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(advisory))
        write_dated_parquet(rows, path, order=[F.col("id")])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", saved)
    sizes = {}
    for folder in os.listdir(local_path(path)):
        if folder.startswith("odate="):
            inside = os.path.join(local_path(path), folder)
            sizes[folder[6:]] = sorted(os.path.getsize(os.path.join(inside, f)) for f in os.listdir(inside) if f.endswith(".parquet"))
    assert len(sizes) == 8 and len(sizes["20240101"]) > 4
    assert all(len(files) == 1 for day, files in sizes.items() if day != "20240101")
    assert sum(s < advisory // 2 for s in sizes["20240101"]) <= 1
    assert read_partitioned_parquet(spark, path).count() == 20_000
    with pytest.raises(Exception, match="a row without odate"):
        write_dated_parquet(rows.withColumn("odate", F.lit(None).cast("string")), scratch_path(spark, "t_undated"))


def test_failed_parquet_write_keeps_the_previous_day(spark):
    path = scratch_path(spark, "t_parquet_fail")
    assert write_partitioned_parquet(frame(spark, 3, "old"), path, "20240101")
    broken = spark.range(3).selectExpr("CAST(id AS INT) AS k", "CASE WHEN id = 2 THEN raise_error('boom') ELSE 'new' END AS tag")
    with pytest.raises(Exception):
        write_partitioned_parquet(broken, path, "20240101", empty=False)
    got = read_partitioned_parquet(spark, path).groupBy("odate", "tag").count().collect()
    assert [(r["odate"], r["tag"], r["count"]) for r in got] == [("20240101", "old", 3)]
