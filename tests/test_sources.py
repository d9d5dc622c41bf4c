from __future__ import annotations

import pytest
from logs import event, log, random_log
from pyspark.sql import functions as F

from playtrail.operators import clean_activity, page_frequency
from playtrail.schema import ACTIVITY, ACTIVITY_COLUMNS
from playtrail.sources import (
    ReadReport,
    materialize,
    missing_columns,
    new_shared_path,
    read_activity,
    rejected_activity,
    require_columns,
    schema_by_file,
    schema_report,
    shared_folder,
)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_round_trip(spark, tmp_path, fmt):
    raw = random_log(spark, 11, users=10)
    path = str(tmp_path / fmt)
    raw.write.format(fmt).save(path)
    read = read_activity(spark, path, fmt)
    assert [(f.name, f.dataType) for f in read.schema] == [(f.name, f.dataType) for f in ACTIVITY]
    assert rows_of(read) == rows_of(raw)


def test_several_paths_are_one_log(spark, tmp_path):
    paths = []
    for part in ("a", "b"):
        paths.append(str(tmp_path / part))
        log(spark, [event(user=part)]).write.parquet(paths[-1])
    assert {r.userId for r in read_activity(spark, paths, "parquet").collect()} == {"a", "b"}


def written_lines(tmp_path, *lines):
    path = tmp_path / "log.json"
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_json_may_lack_fields_and_hold_others(spark, tmp_path):
    path = written_lines(
        tmp_path,
        '{"userId":"7","sessionId":1,"ts":5,"page":"Home","registration":1}',
        '{"userId":"8"}',
    )
    rows = {r.userId: r for r in read_activity(spark, path).collect()}
    assert rows["7"].ts == 5 and rows["8"].sessionId is None and rows["8"].page is None


@pytest.mark.parametrize(
    "session, ts", [("12", "1704110400000"), ('"12"', "1.7041104E12"), ("12.0", '"1704110400000"')]
)
def test_numbers_as_text_and_whole_floats_are_kept(spark, tmp_path, session, ts):
    path = written_lines(tmp_path, f'{{"userId":7,"sessionId":{session},"ts":{ts},"page":"Home"}}')
    (row,) = clean_activity(read_activity(spark, path)).collect()
    assert (row.userId, row.sessionId, row.ts) == ("7", 12, 1704110400000)


def test_reading_runs_nothing_and_the_report_is_of_the_same_pass(spark, tmp_path):
    path = written_lines(
        tmp_path,
        '{"userId":"7","sessionId":1,"ts":5,"page":"Home"}',
        '{"userId":"8","sessionId":2,"ts":"noon","page":null}',
        "not json",
    )
    report = ReadReport()
    sc = spark.sparkContext
    sc.setJobGroup("reading", "reading")
    rows = read_activity(spark, path, on_reject="null", report=report)
    rejected = rejected_activity(spark, path)
    assert not sc.statusTracker().getJobIdsForGroup("reading")
    assert len(rows.collect()) == 3
    jobs = sc.statusTracker().getJobIdsForGroup("reading")
    assert (report.rows, report.rejected) == (3, 2)
    assert report.values["userId"] == 2 and report.values["ts"] == 1 and report.values["page"] == 1
    assert len(sc.statusTracker().getJobIdsForGroup("reading")) == len(jobs)
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert rejected.count() == report.rejected
    report.require()


def test_a_needed_field_that_never_occurs_is_refused_after_the_read(spark, tmp_path):
    path = written_lines(tmp_path, '{"userId":"7","ts":5,"page":"Home"}')
    report = ReadReport("lacking")
    assert read_activity(spark, path, report=report).count() == 1
    with pytest.raises(ValueError, match="sessionId"):
        report.require()


def test_a_log_without_any_page_is_legal(spark, tmp_path):
    path = written_lines(tmp_path, '{"userId":"7","sessionId":1,"ts":5,"page":null}')
    report = ReadReport("pageless")
    read = read_activity(spark, path, report=report)
    assert [r.page for r in page_frequency(read).collect()] == [None]
    report.require()
    with pytest.raises(ValueError, match="page"):
        report.require("page")


def test_an_empty_log_lacks_nothing(spark, tmp_path):
    path = tmp_path / "empty.json"
    path.write_text("")
    report = ReadReport("empty")
    assert read_activity(spark, str(path), report=report).count() == 0
    report.require()


@pytest.mark.parametrize(
    "text, number",
    [
        ("9007199254740993.0", 9007199254740993),
        ("9223372036854775807", 2**63 - 1),
        ("-9223372036854775808.00", -(2**63)),
        ("1e3", 1000),
        ("9223372036854775808", None),
        ("1.5", None),
        ("1.0000000000001", None),
        ('"NaN"', None),
    ],
)
def test_large_whole_numbers_are_exact(spark, tmp_path, text, number):
    path = written_lines(tmp_path, f'{{"userId":"7","sessionId":{text},"ts":5,"page":"Home"}}')
    (row,) = read_activity(spark, path, on_reject="null").collect()
    assert row.sessionId == number
    assert rejected_activity(spark, path).count() == (number is None)


def test_schema_by_file_of_json(spark, tmp_path):
    for name, lines in {
        "a.json": ['{"userId":"7","sessionId":1,"ts":5,"page":"Home","length":1.5}', "junk"],
        "b.json": ['{"userId":"8","sessionId":"x","ts":6.0}', '{"userId":9,"sessionId":2}'],
    }.items():
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    report = schema_by_file(spark, str(tmp_path), "json").collect()
    found = {(r.file.rsplit("/", 1)[1], r.column): (r.declared, r.found, r["rows"], r["values"], r.misfits) for r in report}
    assert len(found) == 2 * len(ACTIVITY_COLUMNS)
    assert found["a.json", "sessionId"] == ("bigint", "bigint", 2, 1, 0)
    assert found["a.json", "length"] == ("double", "double", 2, 1, 0)
    assert found["a.json", "level"] == ("string", "absent", 2, 0, 0)
    assert found["b.json", "sessionId"] == ("bigint", "string", 2, 2, 1)
    assert found["b.json", "ts"] == ("bigint", "double", 2, 1, 0)
    assert found["b.json", "page"] == ("string", "absent", 2, 0, 0)


def test_schema_by_file_names_every_file_of_a_path(spark, tmp_path):
    path = str(tmp_path / "two")
    log(spark, [event(user="a"), event(user="b")]).repartition(2, "userId").write.parquet(path)
    log(spark, [event(user="c")]).drop("artist").write.mode("append").parquet(path)
    report = schema_by_file(spark, path)
    assert report.select("file").distinct().count() >= 2
    assert {r["rows"] for r in report.where("column = 'userId'").collect()} <= {1, 2}
    with pytest.raises(ValueError, match="csv"):
        schema_by_file(spark, path, "csv")


@pytest.mark.parametrize("bad", ["not json", '{"userId":"8","sessionId":2,"ts":"noon","page":"x"}'])
def test_rejected_rows_fail_or_are_listed(spark, tmp_path, bad):
    good = '{"userId":"7","sessionId":1,"ts":5,"page":"Home"}'
    path = written_lines(tmp_path, good, bad)
    with pytest.raises(Exception, match="rejected activity row"):
        read_activity(spark, path).select("page").collect()
    kept = read_activity(spark, path, on_reject="null")
    assert kept.count() == 2 and [r.userId for r in clean_activity(kept).collect()] == ["7"]
    (row,) = rejected_activity(spark, path).collect()
    assert row.rejected in ("no JSON", "ts=noon")


def test_each_parquet_path_is_checked(spark, tmp_path):
    paths = [str(tmp_path / part) for part in ("a", "b")]
    log(spark, [event()]).write.parquet(paths[0])
    log(spark, [event()]).drop("sessionId").write.parquet(paths[1])
    with pytest.raises(ValueError, match="sessionId"):
        read_activity(spark, paths, "parquet")


def test_narrower_numbers_in_parquet_are_widened(spark, tmp_path):
    path = str(tmp_path / "narrow")
    narrow = log(spark, [event()]).withColumn("sessionId", F.col("sessionId").cast("int"))
    narrow.write.parquet(path)
    assert dict(read_activity(spark, path, "parquet").dtypes)["sessionId"] == "bigint"


def test_parquet_without_required_columns_is_refused(spark, tmp_path):
    path = str(tmp_path / "short")
    log(spark, [event()]).drop("level").write.parquet(path)
    with pytest.raises(ValueError, match="level string"):
        read_activity(spark, path, "parquet")


def test_wrong_type_is_reported(spark):
    wrong = log(spark, [event()]).withColumn("ts", F.lit("x"))
    assert missing_columns(wrong) == ["ts bigint"]
    with pytest.raises(ValueError):
        require_columns(wrong)


def test_unknown_format_is_refused(spark):
    with pytest.raises(ValueError, match="csv"):
        read_activity(spark, "anywhere", "csv")


def test_schema_report(spark):
    report = schema_report(log(spark, []))
    assert [r.column for r in report.collect()] == ACTIVITY_COLUMNS


def test_tables_go_to_the_folder_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_folder(spark) == named.rstrip("/")
    first, second = new_shared_path(spark, "x"), new_shared_path(spark, "x")
    assert first != second and first.startswith(shared_folder(spark))


def test_materialized_table_no_longer_depends_on_its_source(spark):
    raw = log(spark, [event(ts=1), event(ts=2)])
    table = materialize(raw, "test-log")
    assert rows_of(table) == rows_of(raw)
    assert table.schema == raw.schema
    assert all(shared_folder(spark) in path for path in table.inputFiles())


class BareSession:
    """A session that names no shared folder."""

    def __init__(self, master):
        self.master = master
        self.folder = None
        self.conf = self.sparkContext = self

    def get(self, key, default):
        return default

    def getCheckpointDir(self):
        return self.folder


@pytest.mark.parametrize("master", ["yarn", "local[2]"])
def test_a_session_without_a_shared_folder_is_refused(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(BareSession(master))
