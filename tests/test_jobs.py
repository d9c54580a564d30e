"""The jobs: runs over growing input on copies, runs again, runs after a crash."""

import logging
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from jobs import common, note_ledger, queries, run_report

SF = Path("/root/testdata/sf0.001")
ROOT = Path(__file__).resolve().parents[1]
pytestmark = pytest.mark.skipif(not SF.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    for t in ("events", "supplier", "documents"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def rows(df):
    columns = sorted(df.columns)
    return sorted(map(str, (tuple(r[c] for c in columns) for r in df.collect())))


def said(duck, name):
    found = duck.execute(queries.SQL[name])
    names = [d[0] for d in found.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(str(tuple(r[i] for i in order)) for r in found.fetchall())


@pytest.mark.parametrize("name", sorted(queries.ALL))
def test_two_runs_into_one_folder_equal_the_sql(spark, duck, name):
    before = dict(spark.conf.getAll)
    assert rows(queries.ALL[name](spark, str(SF))) == said(duck, name)
    assert dict(spark.conf.getAll) == before


# --- the report ---------------------------------------------------------------------------------------------------------
def test_a_report_of_some_files_leaves_the_others(spark, duck, tmp_path, caplog):
    tables, out = tmp_path / "tables", str(tmp_path / "report")
    shutil.copytree(SF, tables)
    caplog.set_level(logging.INFO, "run_report")
    first = run_report.run(spark, {"tables": str(tables), "output": out})
    whole = rows(spark.read.parquet(out))
    assert first["timepoints"] == len(whole) and "timepoints with" in caplog.text
    n = spark.read.parquet(out).where("file_i = 2").count()
    shutil.rmtree(f"{out}/file_i=2")
    again = run_report.run(spark, {"tables": str(tables), "output": out, "files": [2]})
    assert again["timepoints"] == n and rows(spark.read.parquet(out)) == whole

    from pyspark.sql import functions as F

    events = spark.read.parquet(f"{SF}/events.parquet")
    moved = events.withColumn("event_type", F.when(F.to_date("ts") < "2024-01-06", F.lit("view")).otherwise(F.col("event_type")))
    moved.toPandas().to_parquet(tables / "events.parquet", coerce_timestamps="us")
    run_report.run(spark, {"tables": str(tables), "output": out, "files": [0]})
    after = spark.read.parquet(out)
    assert after.where("file_i = 0 and dropped <> ''").count() == 0
    assert rows(after.where("file_i > 0")) == [r for r in whole if r in set(rows(after.where("file_i > 0")))]


def test_done_is_what_the_result_log_has(spark, tmp_path):
    """The log grows between two runs; its second append has one task's result anew and two others'."""
    from tesserae.plans.acquisition import Acquisition
    from tesserae.sources import store

    keys = [r.key for r in Acquisition(spark, str(SF)).plan.orderBy("key").limit(5).collect()]
    results = lambda some: spark.createDataFrame([(k, "time", "w", 0, 0, 0) for k in some], store.OFFSETS)
    config = {"tables": str(SF), "output": f"{tmp_path}/report", "log": f"{tmp_path}/log.jsonl"}
    for some, n in ((keys[:3], 3), (keys[2:], 5)):
        store.append_offsets(results(some), config["log"])
        found = run_report.run(spark, config)
        report = spark.read.parquet(config["output"]).agg({"n_done": "sum", "n_pending": "sum"}).first()
        assert report["sum(n_done)"] == n == found["tasks"] - found["pending"] and report["sum(n_pending)"] == found["pending"]


def test_a_configuration_is_checked():
    for bad in ({"tables": "x"}, {"tables": "x", "output": "y", "file": 1}):
        with pytest.raises(ValueError):
            common.checked(bad, {"tables", "output"}, {"files"})


# --- the ledger ---------------------------------------------------------------------------------------------------------
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def deliver(spark, folder, name, notes):
    """One more file of notes (doc_id, text)."""
    spark.createDataFrame([(d, t, "en", "s", 0) for d, t in notes], SCHEMA).coalesce(1).write.mode("append").parquet(str(folder / name))


def config(tmp_path, **more):
    return {"tables": str(SF), "notes": f"{tmp_path}/notes/*", "output": f"{tmp_path}/out", "checkpoint": f"{tmp_path}/ck", **more}


def held(spark, tmp_path):
    return sorted(((r.doc_id, r.n_words, r.file_i, r.latest) for r in note_ledger.ledger(spark, f"{tmp_path}/out").collect()), key=str)


FIRST = [(1, "one"), (2, "two words"), (3, None), (None, "no id"), (250, "far\x0baway on the  line"), (4, "x " * 50_000), (4, "x " * 50_000)]
SECOND = [(1, "one"), (2, "two words more"), (5, "new"), (3, "")]


def test_growing_notes(spark, tmp_path):
    notes = tmp_path / "notes"
    deliver(spark, notes, "a", FIRST)
    assert note_ledger.run(spark, config(tmp_path)) == {"batches": 1, "read": 7, "lines": 6}
    before = held(spark, tmp_path)
    assert [r[:2] for r in before] == sorted([(1, 1), (2, 2), (3, 0), (None, 2), (250, 5), (4, 50_000)], key=str) and all(r[3] for r in before)
    assert {r[2] for r in before if r[0] is None} == {-1}
    assert note_ledger.run(spark, config(tmp_path)) == {"batches": 0, "read": 0, "lines": 0} and held(spark, tmp_path) == before

    deliver(spark, notes, "b", SECOND)
    assert note_ledger.run(spark, config(tmp_path)) == {"batches": 1, "read": 4, "lines": 2}  # 1 and 3 are known
    after = held(spark, tmp_path)
    assert {(d, n): last for d, n, _, last in after if d in (1, 2, 5)} == {(1, 1): True, (2, 2): False, (2, 3): True, (5, 1): True}
    latest = spark.read.schema(note_ledger.LEDGER).parquet(f"{tmp_path}/out/latest")
    assert latest.count() == latest.select("doc_id").distinct().count() == 7


@pytest.mark.parametrize("step", [0, 1])
def test_a_batch_that_broke_off_is_run_again(spark, tmp_path, monkeypatch, step):
    """It breaks off before a line is written, or between the lines and the latest revisions."""
    notes = tmp_path / "notes"
    deliver(spark, notes, "a", FIRST)
    note_ledger.run(spark, config(tmp_path))
    deliver(spark, notes, "b", SECOND)
    real, calls = note_ledger._replace, []

    def breaks(*args):
        calls.append(args[1])
        if len(calls) == step + 1:
            raise OSError("gone")
        real(*args)

    monkeypatch.setattr(note_ledger, "_replace", breaks)
    with pytest.raises(Exception, match="gone"):
        note_ledger.run(spark, config(tmp_path))
    monkeypatch.undo()
    note_ledger.run(spark, config(tmp_path))
    found = held(spark, tmp_path)
    assert len(found) == 8 and {(d, n): last for d, n, _, last in found if d in (1, 2, 5)} == {(1, 1): True, (2, 2): False, (2, 3): True, (5, 1): True}


def test_many_files_in_small_batches_equal_one_batch(spark, tmp_path):
    notes = tmp_path / "notes"
    for k in range(4):
        deliver(spark, notes, f"f{k}", [(i, f"note {i}") for i in range(k * 10, k * 10 + 12)])
    assert note_ledger.run(spark, config(tmp_path, files_per_batch=1))["batches"] == 4
    one = config(tmp_path) | {"output": f"{tmp_path}/one", "checkpoint": f"{tmp_path}/ck1"}
    assert note_ledger.run(spark, one)["batches"] == 1
    plain = lambda out: rows(note_ledger.ledger(spark, out).drop("batch", "modified"))
    assert plain(f"{tmp_path}/out") == plain(f"{tmp_path}/one") and len(plain(f"{tmp_path}/one")) == 42


def test_a_command_line_makes_and_ends_its_own_session(tmp_path):
    (tmp_path / "c.yaml").write_text(f"tables: {SF}\noutput: nowhere\n")
    done = subprocess.run([sys.executable, "-m", "jobs.run_report", str(tmp_path / "c.yaml"), "--set", f"output={tmp_path}/out"], cwd=ROOT, capture_output=True, text=True, check=True)
    assert "timepoints with" in done.stderr and list((tmp_path / "out").glob("file_i=*"))
