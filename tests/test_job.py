from __future__ import annotations

import contextlib
import gzip
import io
import logging
import os
import time
from datetime import date
from pathlib import Path

import pyarrow.parquet as pq
import pytest

from nestflow import StepError
from nestflow.config import JobConfig
from nestflow.plans import job, run_job
from nestflow.sinks import Publication, read_days, write_parquet, write_partitioned
from nestflow.sinks.publish import Folder
from nestflow.sources import Landing
from nestflow.streaming import (
    flatten_new_rows,
    flatten_taken,
    ingest_new_files,
    take_new_files,
    taken_rows,
)
from nestflow.workspace import drop_folder, shared_folder
from tests.conftest import rows

SCHEMA = "_id int, v array<int>"
STEPS = [
    {"operation": "explode", "column": "v", "alias": "v", "keep": True},
    {"operation": "select", "columns": {"_id": "id", "v": "value"}},
]
WINDOW = date(2024, 1, 1), date(2024, 12, 31)


def record(number, *values):
    return f'<rec id="{number}">{"".join(f"<v>{v}</v>" for v in values)}</rec>'


@pytest.fixture
def land(write_text):
    def write(market, prefix, day, *records, name="f.xml"):
        folder = f"in/{market}/{prefix}/year=2024/month=05/day={day:02d}"
        write_text(f"{folder}/{name}", f"<r>{''.join(records)}</r>")

    return write


def config(tmp_path, **sections):
    return {
        "gcs": {"BUCKET_NAME": f"{tmp_path}/in/{{}}", "BUCKET_OUTPUT": f"{tmp_path}/out"},
        "other": {"kept": "by others"},
        "tech_prefixes": {"2G": "p2", "4G": "p4/", "5G": "p5"},
        "xml_config": {"rowTag": "rec"},
        "output_config": {"output_prefix": "flat", "save_mode": "overwrite"},
        "flattening_config": {"2G": STEPS, "4G": [*STEPS[:1], {"operation": "distinct"}]},
    } | sections


def run(spark, tmp_path, techs=("2G", "4G", "5G"), markets=("SE", "NO"), **options):
    job = JobConfig.from_dict(config(tmp_path))
    options = {"schemas": {t: SCHEMA for t in techs}} | options
    return run_job(spark, job, list(markets), list(techs), *WINDOW, **options)


def of_files(report):
    return report.filter("bytes IS NOT NULL")


def test_run(spark, land, tmp_path, caplog):
    land("SE", "p2", 1, record(1, 10, 11), record(2))
    land("SE", "p2", 2, record(1, 20))  # same file name on another day
    land("NO", "p2", 1, record(1, 30), record(9, "x"))  # and in another market
    land("NO", "p4", 1, record(4, 40, 40))
    land("NO", "p5", 1, record(5, 50))
    with caplog.at_level(logging.WARNING):
        report = run(spark, tmp_path, quarantine=f"{tmp_path}/bad")
    assert "'5G' has no steps" in caplog.text

    out = spark.read.parquet(f"{tmp_path}/out/flat")
    assert rows(out.filter("tech = '2G'").select("market", "day", "id", "value")) == [
        ("NO", 1, 1, 30),
        ("SE", 1, 1, 10),
        ("SE", 1, 1, 11),
        ("SE", 2, 1, 20),
    ]
    assert rows(out.filter("tech = '4G'").select("_id", "v")) == [(4, 40)]
    bad = spark.read.parquet(f"{tmp_path}/bad").select("market", "_corrupt_record")
    assert rows(bad) == [("NO", record(9, "x"))]

    counts = of_files(report).selectExpr(
        "tech",
        "split(source_file, '/in/')[1] LIKE 'SE%' AS se",
        "rows_read",
        "rows_corrupt",
        "rows_written",
        "status",
    )
    assert rows(counts) == [
        ("2G", False, 2, 1, 1, "partly corrupt"),
        ("2G", True, 1, 0, 1, "written"),
        ("2G", True, 2, 0, 2, "written"),
        ("4G", False, 1, 0, 1, "written"),
        ("5G", False, 0, 0, 0, "skipped"),
    ]


def test_rows_are_not_shuffled_to_leave_out_unreadable_files(
    spark, land, write_text, tmp_path, monkeypatch
):
    land("SE", "p2", 1, record(1, 10))
    write_text("in/SE/p2/year=2024/month=05/day=01/broken.xml.gz", "<r></r>")
    plans, split = [], job.split_corrupt

    def noted(scanned):
        text = io.StringIO()
        with contextlib.redirect_stdout(text):
            scanned.explain()
        plans.append(text.getvalue())
        return split(scanned)

    monkeypatch.setattr(job, "split_corrupt", noted)
    report = run(spark, tmp_path, techs=["2G"], markets=["SE"])
    assert [r.status for r in of_files(report).orderBy("status").collect()] == [
        "unreadable", "written",
    ]
    assert len(plans) == 1 and "BroadcastHashJoin" in plans[0]
    assert "SortMergeJoin" not in plans[0]


def test_fields_named_as_the_places_are_replaced(spark, land, tmp_path):
    land("SE", "p2", 1, '<rec id="1"><Year>x</Year><tech>y</tech><v>3</v></rec>')
    job = JobConfig.from_dict(
        config(tmp_path, flattening_config={"2G": [{"operation": "distinct"}]})
    )
    schemas = {"2G": "_id int, Year string, tech string, v int"}
    run_job(spark, job, ["SE"], ["2G"], *WINDOW, schemas=schemas)
    out = spark.read.parquet(f"{tmp_path}/out/flat")
    assert rows(out.select("market", "tech", "year", "_id", "v")) == [("SE", "2G", 2024, 1, 3)]


def test_second_run_replaces_its_days_only(spark, land, tmp_path):
    land("SE", "p2", 1, record(1, 10))
    land("SE", "p2", 2, record(2, 20))
    run(spark, tmp_path)
    land("SE", "p2", 2, record(3, 30))
    job = JobConfig.from_dict(config(tmp_path))
    day = date(2024, 5, 2)
    run_job(spark, job, ["SE"], ["2G"], day, day, {"2G": SCHEMA})
    out = spark.read.parquet(f"{tmp_path}/out/flat")
    assert rows(out.select("id", "value")) == [(1, 10), (3, 30)]


@pytest.mark.parametrize("split_files", [True, False])
def test_inferred_schema(spark, land, tmp_path, split_files):
    land("SE", "p2", 1, record(1, 10, 11), record(2, 5))
    run(spark, tmp_path, schemas=None, split_files=split_files)
    out = spark.read.parquet(f"{tmp_path}/out/flat").select("id", "value")
    assert rows(out) == [(1, 10), (1, 11), (2, 5)]


def test_values_of_an_element_around_the_rows(spark, land, write_text, tmp_path):
    for day in (1, 2):
        records = record("x", 5) + record(1, 10) + record(2, 20)
        land("SE", "p2", day, f'<net id="N{day}">{records}</net>')
    steps = [*STEPS[:1], {"operation": "select", "columns": {"net": "net", "v": "value"}}]
    job = JobConfig.from_dict(config(tmp_path, flattening_config={"2G": steps}))
    around = {"net": ("net", "id")}
    run_job(spark, job, ["SE"], ["2G"], *WINDOW, {"2G": SCHEMA}, ancestors=around)
    out = spark.read.parquet(f"{tmp_path}/out/flat").select("net", "value")
    assert rows(out) == [("N1", 10), ("N1", 20), ("N2", 10), ("N2", 20)]


def test_final_order_holds_in_each_file(spark, land, tmp_path):
    land("SE", "p2", 1, record(1, 5, 9, 7), record(2, 8))
    land("SE", "p4", 1, record(1, 5, 9, 7), record(2, 8))
    up, down = ({"operation": "orderBy", "columns": {"value": up}} for up in (True, False))
    flows = {"2G": [*STEPS, down], "4G": [*STEPS, up]}
    run_job(
        spark,
        JobConfig.from_dict(config(tmp_path, flattening_config=flows)),
        ["SE"],
        ["2G", "4G"],
        *WINDOW,
        {"2G": SCHEMA, "4G": SCHEMA},
    )
    for tech, values in (("2G", [9, 8, 7, 5]), ("4G", [5, 7, 8, 9])):
        files = Path(f"{tmp_path}/out/flat/market=SE/tech={tech}").rglob("*.parquet")
        (written,) = files
        assert pq.read_table(written, columns=["value"])["value"].to_pylist() == values


def test_empty_and_unreadable_files(spark, land, tmp_path):
    land("SE", "p2", 1, name="empty.xml")
    land("SE", "p2", 1, record("x", 1), name="bad.xml")
    land("SE", "p2", 1, record(1), name="no-rows.xml")
    report = run(spark, tmp_path)
    status = of_files(report).selectExpr("split(source_file, 'day=01/')[1] AS file", "status")
    assert rows(status) == [
        ("bad.xml", "corrupt"),
        ("empty.xml", "empty"),
        ("no-rows.xml", "no rows"),
    ]


def test_nothing_landed(spark, tmp_path):
    report = run(spark, tmp_path)
    assert of_files(report).count() == 0
    # Each place that was asked for is told of.
    assert rows(report.select("tech", "status")) == sorted(
        2 * [(tech, "no files") for tech in ("2G", "4G", "5G")]
    )
    assert {"source_file", "status", "tech"} <= set(report.columns)


def test_stage_is_deleted(spark, land, tmp_path):
    def stages():
        return set(Path(shared_folder(spark), "nestflow").glob("stage-*"))

    land("SE", "p2", 1, record(1, 10))
    before = stages()
    report = run(spark, tmp_path)
    assert stages() == before
    assert of_files(report).count() == 1
    with pytest.raises(ValueError, match="was not made by new_folder"):
        drop_folder(spark, str(tmp_path))


def test_only_skipped(spark, land, tmp_path):
    land("SE", "p5", 1, record(1, 1))
    assert [r.status for r in of_files(run(spark, tmp_path)).collect()] == ["skipped"]


def test_stage_is_deleted_after_an_error(spark, land, tmp_path):
    def stages():
        return set(Path(shared_folder(spark), "nestflow").glob("stage-*"))

    land("SE", "p2", 1, record(1, 10))
    before = stages()
    steps = [{"operation": "select", "columns": {"nothing": "x"}}]
    job = JobConfig.from_dict(config(tmp_path, flattening_config={"2G": steps}))
    report = run_job(spark, job, ["SE"], ["2G"], *WINDOW, {"2G": SCHEMA})
    assert stages() == before
    (row,) = of_files(report).collect()
    assert (row.status, row.rows_written) == ("failed", 0)
    assert row.error.startswith("StepError: ")


def test_failures_are_kept_to_their_file_and_technology(spark, land, write_text, tmp_path, caplog):
    land("SE", "p2", 1, record(1, 10), record(2, 20))
    good = gzip.compress(f"<r>{record(3, 30)}{record(4, 40)}</r>".encode() * 400)
    folder = tmp_path / "in/SE/p2/year=2024/month=05/day=01"
    (folder / "cut.xml.gz").write_bytes(good[: len(good) // 2])
    (folder / "noise.xml.gz").write_bytes(b"no archive at all")
    (folder / "whole.xml.gz").write_bytes(gzip.compress(record(7, 70).encode()))
    (folder / "early.xml").write_text(f"<r>{record(8, 80)}<rec id='9'><v>9</v>")
    land("SE", "p4", 1, record(5, 50))
    land("SE", "p5", 1, record(6, 60), record("x", 1))
    flows = {
        "2G": STEPS,
        "4G": [{"operation": "select", "columns": {"nothing": "x"}}],
        # Fails only when it runs.
        "5G": [*STEPS, {"operation": "withColumn", "column": "e", "func": "raise_error('stop')"}],
    }
    job = JobConfig.from_dict(config(tmp_path, flattening_config=flows))
    report = run_job(
        spark, job, ["SE"], list(flows), *WINDOW, dict.fromkeys(flows, SCHEMA),
        quarantine=f"{tmp_path}/bad",
    )
    rows_of = {Path(r.source_file).name if r.tech == "2G" else r.tech: r for r in of_files(report).collect()}
    assert {name: (r.status, r.rows_read, r.rows_written) for name, r in rows_of.items()} == {
        "f.xml": ("written", 2, 2),
        "cut.xml.gz": ("unreadable", 0, 0),
        "noise.xml.gz": ("unreadable", 0, 0),
        "whole.xml.gz": ("written", 1, 1),
        "early.xml": ("partly corrupt", 2, 1),
        "4G": ("failed", 0, 0),
        "5G": ("failed", 2, 0),
    }
    assert "FAILED_READ_FILE" in rows_of["cut.xml.gz"].error
    assert "FAILED_READ_FILE" in rows_of["noise.xml.gz"].error
    assert "step 1" in rows_of["4G"].error and "stop" in rows_of["5G"].error
    assert rows_of["f.xml"].error is None
    out = spark.read.parquet(f"{tmp_path}/out/flat").select("id", "value")
    assert rows(out) == [(1, 10), (2, 20), (7, 70), (8, 80)]
    bad = spark.read.parquet(f"{tmp_path}/bad").select("tech", "_corrupt_record")
    assert ("2G", "<rec id='9'><v>9</v>") in rows(bad)
    assert "technology '5G' failed" in caplog.text


class Crash(Exception):
    pass


@pytest.mark.parametrize("moves", range(7))
@pytest.mark.parametrize("mode", ["overwrite", "append", "ignore", "errorifexists"])
def test_a_crash_between_moves_leaves_old_days_or_new_ones(spark, tmp_path, monkeypatch, mode, moves):
    path = f"{tmp_path}/out"

    def days(*values):
        return spark.createDataFrame([(v, str(v % 10)) for v in values], "v int, day string")

    def publish(df, window):
        publication = Publication(spark, path, ["day"])
        publication.stage(df.repartition(1))
        publication.publish([f"{path}/day={d}" for d in window], mode)

    def found():
        return [r.v for r in read_days(spark, path).orderBy("v").collect()]

    publish(days(1, 2, 3), [])
    old = [1, 2, 3]
    new = {
        "overwrite": [11, 12, 14], "append": [1, 2, 3, 11, 12, 14], "ignore": [1, 2, 3, 14],
        "errorifexists": [1, 2, 3, 14],
    }[mode]
    move, done = Folder.move, []

    def crashing(folder, name, to):
        if len(done) == moves:
            raise Crash
        done.append(name)
        move(folder, name, to)

    with monkeypatch.context() as patch:
        patch.setattr(Folder, "move", crashing)
        try:
            publish(days(14) if mode == "errorifexists" else days(11, 12, 14), "123")
            committed = True
        except Crash:
            # The first move puts the commit record in its place.
            committed = moves > 0
    assert found() == (new if committed else old)
    if mode == "overwrite":
        publish(days(21), "124" if committed else "123")
        assert found() == [21]
    assert not [p for p in Path(path).glob("_*") if not committed and "commit" in p.name]


def test_only_changed_days_are_read(spark, land, write_text, tmp_path):
    def go(name, last=None):
        job = JobConfig.from_dict(config(tmp_path))
        report = run_job(
            spark, job, ["SE"], ["2G"], *WINDOW, {"2G": SCHEMA}, report=f"{tmp_path}/{name}",
            last_report=last and f"{tmp_path}/{last}",
        )
        return {r.source_file.split("day=")[1]: r for r in of_files(report).collect()}

    def out():
        return rows(spark.read.parquet(f"{tmp_path}/out/flat").select("id", "value"))

    for day in (1, 2, 3, 4):
        land("SE", "p2", day, record(day, 10 * day))
    assert {r.taken for r in go("r1").values()} == {True}
    land("SE", "p2", 2, record(2, 21, 22))  # changed
    land("SE", "p2", 3, record(5, 50), name="g.xml")  # new beside another
    (tmp_path / "in/SE/p2/year=2024/month=05/day=04/f.xml").unlink()  # gone
    second = go("r2", last="r1")
    assert {name: (r.taken, r.rows_written) for name, r in second.items()} == {
        "01/f.xml": (False, 1), "02/f.xml": (True, 2), "03/f.xml": (True, 1), "03/g.xml": (True, 1),
    }
    assert out() == [(1, 10), (2, 21), (2, 22), (3, 30), (5, 50)]
    # Nothing has changed since, also in a report that is written over.
    assert {r.taken for r in go("r2", last="r2").values()} == {False}
    assert len(out()) == 5
    with pytest.raises(ValueError, match="only days that are replaced"):
        run_job(
            spark,
            JobConfig.from_dict(config(tmp_path, output_config={"save_mode": "append"})),
            ["SE"], ["2G"], *WINDOW, {"2G": SCHEMA}, last_report=f"{tmp_path}/r2",
        )


def test_order_over_all_files_of_a_day(spark, land, tmp_path):
    for name in ("a", "b", "c"):
        records = [record(i, *range((7 * i) % 50, 400, 3)) for i in range(40)]
        land("SE", "p2", 1, *records, name=f"{name}.xml")
    down = {"operation": "orderBy", "columns": {"value": False, "id": True}}
    job = JobConfig.from_dict(config(tmp_path, flattening_config={"2G": [*STEPS, down]}))
    # Else Spark makes one file of so few rows.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        run_job(spark, job, ["SE"], ["2G"], *WINDOW, {"2G": SCHEMA})
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = sorted(Path(f"{tmp_path}/out/flat").rglob("*.parquet"))
    assert len(files) > 2
    values = []
    for file in files:
        part = pq.read_table(file, columns=["value", "id"], partitioning=None)
        values += [(-v, i) for v, i in zip(*(part[c].to_pylist() for c in ("value", "id")), strict=True)]
    assert values == sorted(values) and len(values) == spark.read.parquet(f"{tmp_path}/out/flat").count()


MODES = {
    # Second run: rows of the first day gone, the second day's file has others, a third day.
    "overwrite": ([(2, 21), (3, 30)], {2: 1, 3: 1}),
    "append": ([(1, 10), (2, 20), (2, 21), (3, 30)], {2: 1, 3: 1}),
    "ignore": ([(1, 10), (2, 20), (3, 30)], {2: 0, 3: 1}),
}


@pytest.mark.parametrize("mode", [*MODES, "errorifexists"])
def test_modes_hold_for_each_day(spark, land, tmp_path, mode):
    out = {"output_prefix": "flat", "save_mode": mode}
    job = JobConfig.from_dict(config(tmp_path, output_config=out))

    def go(start=1):
        window = date(2024, 5, start), date(2024, 5, 31)
        return of_files(run_job(spark, job, ["SE"], ["2G"], *window, {"2G": SCHEMA}))

    def written():
        return rows(spark.read.parquet(f"{tmp_path}/out/flat").select("id", "value"))

    land("SE", "p2", 1, record(1, 10))
    land("SE", "p2", 2, record(2, 20))
    assert {r.rows_written for r in go().collect()} == {1}
    land("SE", "p2", 1, record(1))  # no rows any more
    land("SE", "p2", 2, record(2, 21))
    land("SE", "p2", 3, record(3, 30))
    if mode == "errorifexists":
        with pytest.raises(FileExistsError, match="'day': '02'"):
            go()
        assert written() == [(1, 10), (2, 20)]
        assert {r.rows_written for r in go(start=3).collect()} == {1}
        assert written() == [(1, 10), (2, 20), (3, 30)]
        return
    report = {r.source_file.split("day=")[1][:2]: r for r in go().collect()}
    expected, counts = MODES[mode]
    assert written() == expected
    assert report["01"].rows_read == 1 and report["01"].rows_written == 0
    assert {day: report[f"{day:02}"].rows_written for day in counts} == counts
    assert report["03"].output == "f.parquet"


def test_output_without_rows_can_be_read(spark, land, tmp_path):
    land("SE", "p2", 1, record(1))
    run(spark, tmp_path)
    out = spark.read.parquet(f"{tmp_path}/out/flat")
    assert {"id", "value", "source_file", "market", "day"} <= set(out.columns)
    assert out.count() == 0
    land("SE", "p2", 1, record(1, 5))
    run(spark, tmp_path)
    assert spark.read.parquet(f"{tmp_path}/out/flat").count() == 1


def test_files_below_a_day(spark, write_text, tmp_path):
    for place in ("a.xml", "sub/b.xml"):
        folder = "in/SE/p2/year=2024/month=05/day=01"
        write_text(f"{folder}/{place}", f"<r>{record(1, 10)}</r>")
    report = run(spark, tmp_path)
    assert of_files(report).count() == 2
    assert spark.read.parquet(f"{tmp_path}/out/flat").count() == 2


def test_row_tag_without_the_prefix(spark, write_text, tmp_path):
    folder = "in/SE/p2/year=2024/month=05/day=01"
    text = '<x:all xmlns:x="urn:x"><x:rec id="1"><x:v>10</x:v><x:v>11</x:v></x:rec></x:all>'
    write_text(f"{folder}/a.xml", text)
    for tag in ("rec", "x:rec"):
        xml = {"rowTag": tag, "ignoreNamespace": True}
        job = JobConfig.from_dict(config(tmp_path, xml_config=xml))
        run_job(spark, job, ["SE"], ["2G"], *WINDOW, {"2G": SCHEMA})
        out = spark.read.parquet(f"{tmp_path}/out/flat").select("id", "value")
        assert rows(out) == [(1, 10), (1, 11)]


def test_two_ancestors_in_a_file(spark, land, tmp_path):
    nets = "".join(f'<net id="N{n}">{record(n, n * 10)}</net>' for n in (1, 2))
    land("SE", "p2", 1, nets)
    steps = [*STEPS[:1], {"operation": "select", "columns": {"net": "net", "v": "value"}}]
    sections = {"flattening_config": {"2G": steps}, "ancestors": {"net": ["net", "id"]}}
    job = JobConfig.from_dict(config(tmp_path, **sections))
    run_job(spark, job, ["SE"], ["2G"], *WINDOW, {"2G": SCHEMA})
    out = spark.read.parquet(f"{tmp_path}/out/flat").select("net", "value")
    assert rows(out) == [("N1", 10), ("N2", 20)]


@pytest.mark.parametrize("how", ["right", "full_outer", None])
def test_steps_that_are_not_for_a_job(tmp_path, how):
    step = {"operation": "join", "on": "id", "how": how} if how else {"operation": "union"}
    with pytest.raises(StepError, match="of no file"):
        JobConfig.from_dict(config(tmp_path, flattening_config={"2G": [step]}), ["other"])


def test_command_line(spark, land, write_text, tmp_path):
    """A YAML flow with a schema and a join, from the command line."""
    pytest.importorskip("yaml")
    import run_job as command

    land("SE", "p2", 1, record(1, 10), record(2, 20), record("x", 1))
    names = spark.createDataFrame([(1, "one"), (2, "two")], "id int, name string")
    names.write.parquet(f"{tmp_path}/names")
    path = write_text(
        "config.yaml",
        f"""
        gcs: {{BUCKET_NAME: "{tmp_path}/in/{{}}", BUCKET_OUTPUT: "{tmp_path}/out"}}
        tech_prefixes: {{2G: p2}}
        xml_config: {{rowTag: rec}}
        output_config: {{output_prefix: flat, save_mode: overwrite}}
        schemas: {{2G: "_id int, v array<int>"}}
        inputs: {{names: "{tmp_path}/names"}}
        flattening_config:
          2G:
            - {{operation: explode, column: v, alias: v, keep: true}}
            - operation: select
              missing: null
              columns: {{_id: id, v: value, absent: absent}}
            - {{operation: join, with: names, on: id, how: left_outer}}
        """,
    )
    command.main(
        ["--config", path, "--start-date", "20240501", "--end-date", "20240502", "--lm", "SE,NO",
         "--techs", "2G", "--quarantine", f"{tmp_path}/bad", "--report", f"{tmp_path}/report"]
    )
    out = spark.read.parquet(f"{tmp_path}/out/flat").select("id", "value", "absent", "name")
    assert rows(out) == [(1, 10, None, "one"), (2, 20, None, "two")]
    report = spark.read.parquet(f"{tmp_path}/report").select("rows_read", "status")
    assert rows(report) == [(3, "partly corrupt"), (None, "no files")]
    assert spark.read.parquet(f"{tmp_path}/bad").count() == 1


def test_stream_takes_files_of_any_date(spark, write_text, tmp_path):
    landing = Landing(f"{tmp_path}/in/{{}}", {"2G": "p2"})
    folder = "in/SE/p2/year=2024/month=05/day=01"
    names = [str(tmp_path / name) for name in ("in", "raw", "c")]

    def take():
        ingest_new_files(spark, landing, names[0], "rec", SCHEMA, names[1], names[2])
        return sorted(r["_id"] for r in spark.read.parquet(names[1]).collect())

    write_text(f"{folder}/a.xml", f"<r>{record(1, 1)}</r>")
    assert take() == [1]
    old = write_text(f"{folder}/b.xml", f"<r>{record(2, 2)}</r>")
    os.utime(old, (time.time() - 30 * 86400,) * 2)
    assert take() == [1, 2]


class TestConfig:
    def test_yaml(self, write_text):
        pytest.importorskip("yaml")
        path = write_text(
            "config.yaml",
            """
            gcs: {BUCKET_NAME: "gs://b-{}-in", BUCKET_OUTPUT: "gs://out/x/"}
            tech_prefixes: {5G: im/5g}
            output_config: {output_prefix: flat, save_mode: append}
            flattening_config:
              5G:
                - operation: join
                  on: "id"
                  how: "left_outer"
                - {operation: orderBy, columns: {a: True, b: False}}
            """,
        )
        job = JobConfig.from_yaml(path, inputs=["other"])
        assert job.output == "gs://out/x/flat"
        assert job.row_tag == "configData"
        assert job.save_mode == "append"
        assert job.steps["5G"][0]["on"] == "id"
        assert job.landing.roots(["de"], ["5G"]) == ["gs://b-de-in/im/5g"]

    @pytest.mark.parametrize(
        "change, problem",
        [
            ({"gcs": {"BUCKET_NAME": "b"}}, r"'gcs' needs \['BUCKET_OUTPUT'\]"),
            ({"gcs": None}, "'gcs' needs"),
            ({"tech_prefixes": {}}, "tech_prefixes"),
            ({"output_config": {"save_mode": "replace"}}, "unknown save mode 'replace'"),
            ({"flattening_config": {"2G": [{"operation": "x"}]}}, r"step 1 \(x\)"),
        ],
    )
    def test_problems(self, tmp_path, change, problem):
        with pytest.raises(ValueError, match=problem):
            JobConfig.from_dict(config(tmp_path, **change))


class TestSinks:
    @pytest.mark.parametrize(
        "mode, left",
        [("overwrite", [1]), ("append", [0, 1]), ("ignore", [0]), ("errorifexists", [0])],
    )
    def test_modes(self, spark, tmp_path, mode, left):
        path = f"{tmp_path}/t"
        write_parquet(spark.range(1), path, mode)
        second = spark.range(1, 2)
        if mode == "errorifexists":
            with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
                write_parquet(second, path, mode)
        else:
            write_parquet(second, path, mode)
        assert [r.id for r in spark.read.parquet(path).orderBy("id").collect()] == left

    def test_unknown_mode(self, spark, tmp_path):
        for write in (write_parquet, lambda df, p, m: write_partitioned(df, p, ["id"], m)):
            with pytest.raises(ValueError, match="unknown save mode"):
                write(spark.range(1), f"{tmp_path}/t", "upsert")

    @pytest.mark.parametrize("rebalance", [True, False])
    def test_other_partitions_stay(self, spark, tmp_path, rebalance):
        path = f"{tmp_path}/t"
        first = spark.sql("SELECT id, id % 3 AS p FROM range(9)")
        write_partitioned(first, path, ["p"], rebalance=rebalance)
        write_partitioned(spark.sql("SELECT 100L AS id, 1L AS p"), path, ["p"], rebalance=rebalance)
        out = spark.read.parquet(path).select("id", "p")
        assert rows(out) == sorted(
            [(i, i % 3) for i in range(9) if i % 3 != 1] + [(100, 1)], key=repr
        )


def test_stream_takes_each_file_once(spark, write_text, tmp_path):
    landing = Landing(f"{tmp_path}/in/{{}}", {"2G": "p2"})

    def at(name):
        return str(tmp_path / name)

    def run_twice_a_day():
        ingest_new_files(
            spark, landing, at("in"), "rec", SCHEMA, at("raw"), at("c1"), files_per_batch=1
        )
        flatten_new_rows(spark, at("raw"), STEPS, at("flat"), at("c2"))
        flat = spark.read.parquet(at("flat"))
        return rows(flat.select("market", "tech", "month", "id", "value"))

    folder = "in/SE/p2/year=2024/month=05/day=01"
    write_text(f"{folder}/a.xml", f"<r>{record(1, 10, 11)}</r>")
    write_text(f"{folder}/b.xml", f"<r>{record(2, 20)}{record('x', 1)}</r>")
    first = [("SE", "2G", "05", 1, 10), ("SE", "2G", "05", 1, 11), ("SE", "2G", "05", 2, 20)]
    assert run_twice_a_day() == first
    write_text(f"{folder}/c.xml", f"<r>{record(3, 30)}</r>")
    assert run_twice_a_day() == [*first, ("SE", "2G", "05", 3, 30)]
    assert run_twice_a_day() == [*first, ("SE", "2G", "05", 3, 30)]
    bad = spark.read.parquet(at("raw")).filter("_corrupt_record IS NOT NULL")
    assert [r._corrupt_record for r in bad.collect()] == [record("x", 1)]


def test_ledger_takes_files_that_are_new_or_changed(spark, write_text, tmp_path, monkeypatch):
    landing = Landing(f"{tmp_path}/in/{{}}", {"2G": "p2"})
    out, folder = str(tmp_path / "taken"), "in/SE/p2/year=2024/month=05/day=01"

    def go(most=2):
        found = take_new_files(spark, landing, str(tmp_path / "in"), "rec", SCHEMA, out, most)
        return rows(found.selectExpr("split(source_file, 'day=01/')[1] AS f", "batch", "complete"))

    def flat():
        return rows(flatten_taken(spark, out, STEPS).select("day", "id", "value"))

    assert go() == []
    for n, name in enumerate(("a", "b", "{c} [1]"), 1):
        write_text(f"{folder}/{name}.xml", f"<r>{record(n, 10 * n)}</r>")
    (tmp_path / folder / "bad.xml.gz").write_bytes(b"no archive")
    write_text(f"{folder}/empty.xml", "")
    first = [("a.xml", 0, True), ("b.xml", 0, True), ("bad.xml.gz", 1, None), ("{c} [1].xml", 1, True)]
    assert go() == first
    assert flat() == [("01", n, 10 * n) for n in (1, 2, 3)]
    # Written again, in another size, cut off, and filled.
    write_text(f"{folder}/a.xml", f"<r>{record(1, 11, 12)}</r>")
    write_text(f"{folder}/cut.xml", f"<r>{record(5, 50)}<rec id='6'><v>60</v>")
    write_text(f"{folder}/empty.xml", f"<r>{record(7, 70)}</r>")
    # A run that dies after the rows are written, before the ledger has them.
    with monkeypatch.context() as patch:
        patch.setattr(Folder, "move", lambda *_: (_ for _ in ()).throw(Crash()))
        with pytest.raises(Crash):
            go(10)
    assert flat() == [("01", n, 10 * n) for n in (1, 2, 3)]
    later = [("a.xml", 2, True), ("cut.xml", 2, False), ("empty.xml", 2, True)]
    assert go(10) == sorted([*first, *later], key=repr) == go(10)
    want = [("01", 1, 11), ("01", 1, 12), ("01", 2, 20), ("01", 3, 30), ("01", 5, 50), ("01", 7, 70)]
    assert flat() == want
    bad = taken_rows(spark, out).filter("_corrupt_record IS NOT NULL")
    assert [r._corrupt_record for r in bad.collect()] == ["<rec id='6'><v>60</v>"]
    assert rows(taken_rows(spark, out, after=1).select("_id").filter("_id > 4")) == [(5,), (7,)]
