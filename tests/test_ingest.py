"""Landing of files: repeatable, tolerant of broken files, complete."""

import shutil

import pytest
from conftest import rows_of
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tallybeat.operators import quality
from tallybeat.plans import ingest
from tallybeat.sources import files
from tallybeat.streaming import ingest as streaming

DATE = "2025-02-01"


def deliver(spark, folder, number, start, rows):
    """One Parquet file with a numeric name."""
    made = folder.parent / f"made-{number}"
    spark.range(start, start + rows, 1, 1).select(F.col("id").alias("user_id")).write.parquet(str(made))
    folder.mkdir(exist_ok=True)
    shutil.copy(next(made.glob("part-*.parquet")), folder / f"{number}.parquet")


@pytest.fixture
def source(spark, tmp_path):
    folder = tmp_path / "source"
    for number, rows in ((9, 5), (10, 7), (101, 11)):
        deliver(spark, folder, number, number * 1000, rows)
    return folder


def users(spark, target, date=DATE):
    landed = files.read_listens(spark, target, date, "user_id bigint")
    return [row.user_id for row in landed.orderBy("user_id").collect()]


def expected(*numbers):
    sizes = {9: 5, 10: 7, 101: 11, 102: 3}
    return sorted(n * 1000 + i for n in numbers for i in range(sizes[n]))


@pytest.mark.parametrize("per_pass", [1, 2, 100])
def test_first_run_rerun_and_new_file(spark, source, tmp_path, per_pass):
    target = str(tmp_path / f"bronze{per_pass}")

    def run():
        return ingest.ingest(spark, str(source), target, DATE, files_per_pass=per_pass)

    entries = run().orderBy("file_no")
    assert [(row.file_no, row.landed_rows, row.status) for row in entries.collect()] == [
        (9, 5, "LOADED"), (10, 7, "LOADED"), (101, 11, "LOADED"),
    ]
    assert users(spark, target) == expected(9, 10, 101)
    run()
    assert users(spark, target) == expected(9, 10, 101)
    deliver(spark, source, 102, 102_000, 3)
    assert rows_of(ingest.outcome(run()), "status", "files", "landed_rows") == [("LOADED", 4, 26)]
    assert users(spark, target) == expected(9, 10, 101, 102)


def test_broken_file_is_reported_and_tried_again(spark, source, tmp_path):
    target = str(tmp_path / "bronze")
    whole = (source / "10.parquet").read_bytes()
    (source / "10.parquet").write_bytes(whole[: len(whole) // 2])
    deliver(spark, source, 200, 0, 0)
    found = ingest.ingest(spark, str(source), target, DATE)
    assert rows_of(found, "file_name", "landed_rows", "status") == [
        ("10.parquet", 0, "FAILED"), ("101.parquet", 11, "LOADED"), ("200.parquet", 0, "EMPTY"), ("9.parquet", 5, "LOADED"),
    ]
    listed = files.list_files(spark, str(source), "*.parquet")
    arrived = found.filter("status = 'LOADED'")
    assert rows_of(quality.reconcile(listed, arrived, "file_name").filter("status = 'MISSING'"), "file_name") == [
        ("10.parquet",), ("200.parquet",),
    ]
    (source / "10.parquet").write_bytes(whole)
    assert ingest.ingest(spark, str(source), target, DATE).filter("status = 'FAILED'").count() == 0
    assert users(spark, target) == expected(9, 10, 101)


def test_interrupted_run_is_completed_without_doubles(spark, source, tmp_path):
    """Rows that a run left behind which died before it could record them are not read."""
    target = str(tmp_path / "bronze")
    schema = spark.read.parquet(str(source)).schema
    ingest._land(spark, [str(source / "10.parquet")], target, DATE, schema)
    ingest.ingest(spark, str(source), target, DATE)
    ingest._land(spark, [str(source / "9.parquet")], target, DATE, schema)
    assert users(spark, target) == expected(9, 10, 101)
    assert spark.read.parquet(target).count() > 23


def test_many_small_files_land_in_few(spark, tmp_path):
    """Files of a date go by bytes, not by sources; each row says where it comes from."""
    spark.range(6000).repartition(60).write.parquet(str(tmp_path / "many"))
    target = str(tmp_path / "bronze")
    found = ingest.ingest(spark, str(tmp_path / "many"), target, DATE)
    assert rows_of(ingest.outcome(found), "status", "files", "landed_rows") == [("LOADED", 60, 6000)]
    assert len(list((tmp_path / "bronze" / f"ingested_date={DATE}").rglob("*.parquet"))) <= 8
    rows = files.read_listens(spark, target, DATE, "id bigint, source_file string, source_row bigint")
    given = spark.read.parquet(str(tmp_path / "many")).select("id", "_metadata.file_name", "_metadata.row_index")
    assert rows_of(rows, "id", "source_file", "source_row") == rows_of(given)


def test_dates_are_separate(spark, source, tmp_path):
    target = str(tmp_path / "bronze")
    for day in (DATE, "2025-02-02"):
        ingest.ingest(spark, str(source), target, day)
    schema = "user_id bigint"
    assert files.read_listens(spark, target, DATE, schema).count() == 23
    assert files.read_listens(spark, target, schema=schema).count() == 46


def damaged(spark, folder, name):
    """A file of ten row groups, broken in the middle; returns its whole bytes."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    folder.mkdir(exist_ok=True)
    pq.write_table(pa.table({"user_id": pa.array(range(1000), pa.int64())}), folder / name, row_group_size=100, compression="NONE", use_dictionary=False)
    group = pq.ParquetFile(folder / name).metadata.row_group(6).column(0)
    whole = (folder / name).read_bytes()
    at, size = group.data_page_offset, group.total_compressed_size
    (folder / name).write_bytes(whole[:at] + b"\xff" * size + whole[at + size :])
    return whole


def test_half_broken_file_lands_after_repair(spark, source, tmp_path):
    """No row of a file lands before all of them can; the other files do not wait."""
    target = str(tmp_path / "bronze")
    whole = damaged(spark, source, "300.parquet")
    found = ingest.ingest(spark, str(source), target, DATE)
    assert rows_of(ingest.outcome(found), "status", "files", "landed_rows") == [("FAILED", 1, 0), ("LOADED", 3, 23)]
    assert users(spark, target) == expected(9, 10, 101)
    (source / "300.parquet").write_bytes(whole)
    found = ingest.ingest(spark, str(source), target, DATE)
    assert rows_of(ingest.outcome(found), "status", "files", "landed_rows") == [("LOADED", 4, 1023)]
    assert users(spark, target) == sorted([*expected(9, 10, 101), *range(1000)])


def test_second_run_opens_no_old_file(spark, source, tmp_path):
    target = str(tmp_path / "bronze")
    ingest.ingest(spark, str(source), target, DATE)
    schema = spark.read.parquet(str(source)).schema
    (source / "9.parquet").write_bytes(b"no longer a Parquet file")
    again = ingest.ingest(spark, str(source), target, DATE, schema)
    assert rows_of(ingest.outcome(again), "status", "files", "landed_rows") == [("LOADED", 3, 23)]


def test_stream_stops_at_a_broken_file_and_lands_it_after_repair(spark, source, tmp_path):
    places = [str(tmp_path / name) for name in ("target", "checkpoint")]
    whole = damaged(spark, source, "300.parquet")
    with pytest.raises(StreamingQueryException):
        streaming.land_new_files(spark, str(source), *places, DATE, "user_id bigint")
    (source / "300.parquet").write_bytes(whole)
    streaming.land_new_files(spark, str(source), *places, DATE, "user_id bigint")
    assert users(spark, places[0], None) == sorted([*expected(9, 10, 101), *range(1000)])


def test_one_date_is_read_by_its_path(spark, source, tmp_path):
    target = str(tmp_path / "bronze")
    for day in (DATE, "2025-02-02"):
        ingest.ingest(spark, str(source), target, day)
    one = files.read_listens(spark, target, DATE, "user_id bigint")
    assert one.inputFiles() and all(f"ingested_date={DATE}" in name for name in one.inputFiles())
    with pytest.raises(FileNotFoundError):
        files.read_listens(spark, target, "2025-02-30", "user_id bigint")


def test_missing_source_fails_early(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        ingest.ingest(spark, str(tmp_path / "none"), str(tmp_path / "bronze"), DATE)


def test_stream_runs_over_growing_source(spark, source, tmp_path):
    places = [str(tmp_path / name) for name in ("target", "checkpoint")]

    def run():
        streaming.land_new_files(spark, str(source), *places, DATE, "user_id bigint", files_per_batch=2)
        return spark.read.parquet(places[0]).count()

    assert run() == 23
    assert run() == 23
    deliver(spark, source, 102, 102_000, 3)
    assert run() == 26
    assert users(spark, places[0], None) == expected(9, 10, 101, 102)
    assert rows_of(streaming.landed_rows(spark, places[0]), "source_file", "landed_rows") == [
        ("10.parquet", 7), ("101.parquet", 11), ("102.parquet", 3), ("9.parquet", 5),
    ]


def test_listing_order_counts_and_usage(spark, source):
    listed = files.list_files(spark, str(source))
    assert [row.file_no for row in files.numbered(listed).collect()] == [9, 10, 101]
    assert rows_of(files.rows_per_file(spark, str(source))) == [("10.parquet", 7), ("101.parquet", 11), ("9.parquet", 5)]
    usage = quality.prefix_usage(files.list_files(spark, str(source.parent), "*[0-9].parquet"))
    sizes = sum(path.stat().st_size for path in source.iterdir())
    assert rows_of(usage.filter("prefix in ('source', 'TOTAL')"), "prefix", "files", "bytes") == [
        ("TOTAL", 3, sizes), ("source", 3, sizes),
    ]


def test_first_files_by_number_before_and_after_landing(spark, source, tmp_path):
    target = str(tmp_path / "bronze")
    ingest.ingest(spark, str(source), target, DATE)
    for place in (str(source), target):
        first = files.first_files(spark, place, 2, ["user_id"])
        assert rows_of(first.groupBy("file_no").count()) == [(10, 7), (9, 5)]


def test_dump(spark, tmp_path):
    (tmp_path / "d.tsv").write_text("1\t2\tms\t\\N\t-1\t2025-01-01 10:00:00\n2\t3\tms\tmb\t1\tnonsense\n")
    found = files.read_feedback(spark, str(tmp_path)).withColumn("created_at", F.date_format("created_at", "yyyyMMddHH"))
    assert rows_of(found) == [(1, 2, "ms", None, -1, "2025010110"), (2, 3, "ms", "mb", 1, None)]


def test_csv_keeps_any_text(spark, tmp_path):
    texts = ['say "hi"', " padded ", "a,b", "back\\slash", "line\nbreak", "NA", 'end\\"', "ünïcode"]
    frame = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "id string, t string")
    files.write_csv(frame, str(tmp_path / "c"))
    assert rows_of(files.read_csv(spark, str(tmp_path / "c"), free_text=True)) == rows_of(frame)
