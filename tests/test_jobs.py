"""The runnable jobs: growing input, reruns, runs that die, odd rows, and the command line. Inputs are copies."""

import json
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from jobs import common, queries, reaction_intake, source_overlap

ROOT = Path(__file__).resolve().parent.parent
RAW = "ord long, rxn_id string, reactants string, products string, source string"


def rows(df, *without):
    return sorted(map(str, df.drop(*without).collect()))


def raw(spark, n):
    some = [(i, None if i % 5 == 4 else f"r{i}", "N" * (i % 11 + 1), None if i % 7 == 6 else "C", "test") for i in range(n)]
    return spark.createDataFrame(some, RAW)


def test_intake_of_growing_input_is_that_of_one_load(spark, tmp_path):
    grown, once = f"{tmp_path}/grown", f"{tmp_path}/once"
    assert [reaction_intake.take(spark, raw(spark, n), grown) for n in (25, 25, 90)] == [25, 0, 65]
    assert reaction_intake.take(spark, raw(spark, 90), once) == 90
    assert rows(reaction_intake.current(spark, grown), "load") == rows(reaction_intake.current(spark, once), "load")
    loads = spark.read.parquet(f"{grown}/loads").orderBy("load").collect()
    assert [(r.after, r.upto, r.n_rows, r.load) for r in loads] == [(None, 24, 25, 0), (24, 89, 65, 1)]
    # a reaction that an earlier load has is only a source there
    assert spark.read.parquet(f"{grown}/reactions").filter("load > 0").count() == 0
    assert {p.name for p in Path(grown, "reactions").iterdir() if p.is_dir()} == {"load=0"}


def test_intake_takes_a_load_again_that_did_not_finish(spark, tmp_path, monkeypatch):
    output = f"{tmp_path}/out"
    reaction_intake.take(spark, raw(spark, 20), output)
    write = reaction_intake.write_partitions

    def fails(df, path, *by):
        if path.endswith("failures"):
            raise OSError("lost")
        write(df, path, *by)

    monkeypatch.setattr(reaction_intake, "write_partitions", fails)
    with pytest.raises(OSError):
        reaction_intake.take(spark, raw(spark, 40), output)
    monkeypatch.undo()
    assert reaction_intake.take(spark, raw(spark, 70), output) == 50
    reaction_intake.take(spark, raw(spark, 70), f"{tmp_path}/once")
    assert rows(reaction_intake.current(spark, output), "load") == rows(reaction_intake.current(spark, f"{tmp_path}/once"), "load")


def test_intake_of_nothing_and_of_failures_only(spark, tmp_path):
    output = f"{tmp_path}/out"
    assert reaction_intake.take(spark, raw(spark, 0), output) == 0
    assert reaction_intake.current(spark, output).count() == 0
    assert reaction_intake.take(spark, raw(spark, 3).withColumn("products", F.lit(None).cast("string")), output) == 3
    got = reaction_intake.current(spark, output).collect()
    assert {(r.kind, r.failure, r.reaction_hash_v1) for r in got} == {("failure", "missing_reaction_components", None)} and len(got) == 3
    null = spark.createDataFrame([(None, "x", "A", "B", "s")], RAW)
    assert reaction_intake.take(spark, null, output) == 0


def test_intake_of_orders_that_grow(spark, tmp_path):
    """The order tables, copied up to an order key and then whole."""
    sf, tables, output = "/root/testdata/sf0.001", f"{tmp_path}/tables", f"{tmp_path}/out"
    for name, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey"), ("part", None)):
        whole = spark.read.parquet(f"{sf}/{name}.parquet")
        (whole.filter(F.col(key) < 700) if key else whole).write.parquet(f"{tables}/{name}.parquet")
    first = reaction_intake.reaction_intake(spark, tables, output)
    for name in ("orders", "lineitem"):
        spark.read.parquet(f"{sf}/{name}.parquet").write.mode("overwrite").parquet(f"{tables}/{name}.parquet")
    second = reaction_intake.reaction_intake(spark, tables, output)
    assert first > 0 and second > 0 and reaction_intake.reaction_intake(spark, tables, output) == 0
    assert rows(reaction_intake.current(spark, output), "load") == rows(queries.job1_reaction_intake(spark, sf), "load")


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, first, n):
    lines = ["head one", "head two", "", "  "]
    made = []
    for i in range(first, first + n):
        text = None if i % 13 == 0 else f"{lines[i % 4]}\nbody {i % 6}" if i % 4 != 3 else lines[i % 4]
        made.append((i, text, (None, "en", "de")[i % 3], (None, "a", "b", "c")[i % 7 % 4], 0))
    return spark.createDataFrame(made, DOCS)


def test_overlap_of_growing_files_is_that_of_one_run(spark, tmp_path):
    table, grown = f"{tmp_path}/documents.parquet", f"{tmp_path}/grown"
    settings = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    batches = []
    for k, n in enumerate((50, 30, 45)):
        documents(spark, 50 * k, n).repartition(3).write.mode("append").parquet(table)
        batches += [source_overlap.source_overlap(spark, table, grown, max_files=2) for _ in range(2)]
    assert batches[1::2] == [0, 0, 0] and all(batches[::2])
    source_overlap.source_overlap(spark, table, f"{tmp_path}/once")
    got = rows(source_overlap.current(spark, grown))
    assert got == rows(source_overlap.current(spark, f"{tmp_path}/once")) and len(got) > 10
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == settings
    total = spark.read.parquet(f"{grown}/sources").agg(F.sum("n_rows"), F.sum("n_missing")).first()
    assert total[0] == 125 and total[1] == spark.read.parquet(table).filter("coalesce(trim(text), '') = ''").count()


def test_overlap_touches_only_languages_with_new_files(spark, tmp_path):
    table, output = f"{tmp_path}/documents.parquet", f"{tmp_path}/out"
    documents(spark, 0, 60).write.parquet(table)
    source_overlap.source_overlap(spark, table, output)
    files = lambda lang: sorted(p.name for p in Path(output, "sources", f"lang={lang}").glob("*.parquet"))
    before = {x: files(x) for x in ("en", "de", "unknown")}
    documents(spark, 60, 30).filter("lang = 'en'").write.mode("append").parquet(table)
    source_overlap.source_overlap(spark, table, output)
    assert files("en") != before["en"] and files("de") == before["de"] and files("unknown") == before["unknown"]


def test_overlap_reports_what_a_run_that_died_counted(spark, tmp_path, monkeypatch):
    table, output = f"{tmp_path}/documents.parquet", f"{tmp_path}/out"
    documents(spark, 0, 40).write.parquet(table)
    monkeypatch.setattr(source_overlap, "report", lambda counts: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        source_overlap.source_overlap(spark, table, output)
    monkeypatch.undo()
    assert source_overlap.current(spark, output).count() == 0
    assert source_overlap.source_overlap(spark, table, output) > 0
    source_overlap.source_overlap(spark, table, f"{tmp_path}/once")
    assert rows(source_overlap.current(spark, output)) == rows(source_overlap.current(spark, f"{tmp_path}/once"))


def test_overlap_of_an_empty_table(spark, tmp_path):
    table, output = f"{tmp_path}/documents.parquet", f"{tmp_path}/out"
    documents(spark, 0, 0).write.parquet(table)
    for _ in range(2):
        source_overlap.source_overlap(spark, table, output)
    assert source_overlap.current(spark, output).count() == 0


def test_missing_table_is_empty_and_another_fault_is_not(spark, tmp_path):
    assert common.read_or_empty(spark, f"{tmp_path}/none", "a long").count() == 0
    Path(tmp_path, "bad").mkdir()
    Path(tmp_path, "bad", "x.parquet").write_text("no parquet")
    with pytest.raises(Exception):
        common.read_or_empty(spark, f"{tmp_path}/bad", "a long").collect()


def test_command_line(tmp_path):
    config = tmp_path / "config.json"
    config.write_text(json.dumps({"documents": "/root/testdata/sf0.001/documents.parquet", "output": "nowhere", "max_files": 5}))
    args = [sys.executable, "-m", "jobs.source_overlap", "--config", str(config), "--set", f"output={tmp_path}/out", "--set", "max_files=2"]
    done = subprocess.run(args, cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert "read 200 rows" in done.stderr and (tmp_path / "out" / "reported" / "_SUCCESS").exists()


def test_jobs_do_not_know_the_training_text_operators():
    for f in (ROOT / "jobs").glob("*.py"):
        assert "llm" not in f.read_text() and "corpus_pipeline" not in f.read_text()
    assert set(queries.queries()) == set(queries.oracle_sql())
