"""Publishing at once, repeated runs, and the schema registry."""

import glob
import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

import tablewarden.plans.run as runs
from tablewarden import Run, Store, TableRef
from tablewarden.sources.files import Files
from tablewarden.sources.publication import ATTEMPT, Pointers, Publication
from tests.helpers import book

REFS = [TableRef("lake", "unit", f"t{i}") for i in range(4)]
OUTPUTS = [("audit", "dq_summary"), ("audit", "dq_audit_results"), ("audit", "dq_pipeline_runs")]
OUTPUTS += [("candidate", "dq_profile"), ("candidate", "dq_rule_candidates")]


@pytest.fixture
def store(tmp_path):
    return Store(str(tmp_path))


def run(spark, store, run_id, rows, day=1, **options):
    at = F.lit(datetime(2026, 1, day))
    tried = Run(spark, book(), store, at, run_id=run_id, **options)
    return tried.tables(REFS, lambda ref: spark.range(rows).withColumn("x", F.lit(None).cast("int")))


def stored(spark, store):
    return {n: sorted(map(tuple, store.read(spark, *n).collect()), key=repr) for n in OUTPUTS}


def folders(store, name):
    return {os.path.basename(p) for p in glob.glob(f"{store.root}/{'/'.join(name)}/{ATTEMPT}=*")}


def test_a_repeated_run_leaves_the_same_rows(spark, store):
    run(spark, store, "monday", 5)
    once = stored(spark, store)
    assert [len(once[n]) for n in OUTPUTS] == [4, 64, 1, 8, 8]
    run(spark, store, "monday", 5)
    assert stored(spark, store) == once
    run(spark, store, "tuesday", 6, day=2)
    assert [len(rows) for rows in stored(spark, store).values()] == [8, 128, 2, 8, 8]
    run(spark, store, "monday", 5)  # its own rows again; now its profile is the last one
    rows = stored(spark, store)
    assert [len(r) for r in rows.values()] == [8, 128, 2, 8, 8]
    assert {r[5] for r in rows["candidate", "dq_profile"]} == {5}


def test_staged_results_and_what_no_reader_needs_go(spark, store):
    for _ in range(4):
        run(spark, store, "monday", 5)
    assert not folders(store, ("audit", runs.STAGED))
    assert all(len(folders(store, n)) == 2 for n in OUTPUTS)  # what is read, and what was read before
    assert Files(spark, store.root).names("_open") == []


def test_a_run_killed_between_groups_shows_nothing(spark, store, monkeypatch):
    run(spark, store, "monday", 5)
    before, profile, calls = stored(spark, store), runs.profile_table, []

    def killed(*args):
        calls.append(1)
        if len(calls) == 3:
            raise KeyboardInterrupt  # no Exception: nothing in the run can go on
        return profile(*args)

    killed.__name__ = "profile_table"
    monkeypatch.setattr(runs, "profile_table", killed)
    with pytest.raises(KeyboardInterrupt):
        run(spark, store, "tuesday", 9, day=2, tables_per_job=1)
    assert len(folders(store, ("candidate", "dq_profile"))) == 2  # half a profile is there
    assert stored(spark, store) == before  # and is not seen
    monkeypatch.undo()
    run(spark, store, "tuesday", 9, day=2)
    rows = stored(spark, store)
    assert {r[5] for r in rows["candidate", "dq_profile"]} == {9} and len(rows["audit", "dq_summary"]) == 8
    assert len(folders(store, ("candidate", "dq_profile"))) == 2  # the dead half is gone
    assert not folders(store, ("audit", runs.STAGED))


def test_a_group_that_is_written_again_replaces_itself(spark, store):
    attempt = Publication(store, spark, "r", "audit")
    for rows in (3, 5):
        attempt.write(spark.range(rows), ("s", "t"), "0")
        attempt.write(spark.range(1), ("s", "t"), "1")
    assert attempt.own(("s", "t")).count() == 6
    assert store.read(spark, "s", "t").count() == 0 and not store.exists(spark, "s", "t")
    attempt.publish([("s", "t")])
    assert store.read(spark, "s", "t").columns == ["id"] and store.read(spark, "s", "t").count() == 6


def test_runs_that_publish_at_the_same_time_lose_nothing(spark, store, monkeypatch):
    files = Files(spark, store.root)
    pointers, state = Pointers(files), Pointers.state
    stale = iter([(0, [])])  # the first look is too old: another run has published since
    pointers.publish("a", "a1", [("s", "t")], [])
    monkeypatch.setattr(Pointers, "state", lambda self: next(stale, None) or state(self))
    names = Files.names
    first = iter([[]])
    monkeypatch.setattr(Files, "names", lambda self, f: next(first, names(self, f)) if f == "_published" else names(self, f))
    pointers.publish("b", "b1", [("s", "t")], [("s", "u")])
    assert pointers.visible(("s", "t")) == ["a1", "b1"] and pointers.visible(("s", "u")) == ["b1"]


def test_a_pointer_that_is_half_written_is_passed_over(spark, store):
    pointers = Pointers(Files(spark, store.root))
    pointers.publish("a", "a1", [("s", "t")], [])
    with open(f"{store.root}/_published/0000000002.json", "w") as file:
        file.write('{"runs": [')
    assert pointers.visible(("s", "t")) == ["a1"]
    pointers.publish("b", "b1", [("s", "t")], [])
    assert pointers.visible(("s", "t")) == ["a1", "b1"]


def test_a_repeated_run_in_a_catalog(spark):
    scope = {"audit_schema": "unit_twice", "candidate_schema": "unit_twice_profiles"}
    store = Store(catalog="spark_catalog")
    for n, run_id in ((3, "a"), (4, "b"), (5, "b")):
        tried = Run(spark, book(framework=scope), store, run_id=run_id)
        tried.tables(REFS[:1], lambda ref, n=n: spark.range(n))
    counts = [r.row_count for r in spark.table("unit_twice.dq_summary").orderBy("run_timestamp").collect()]
    assert counts == [3, 5]
    assert [r.row_count for r in spark.table("unit_twice_profiles.dq_profile").collect()] == [5]


# --- schema registry ------------------------------------------------------------------------


def test_a_read_opens_no_file_to_plan(spark, store):
    store.write(spark.range(3).selectExpr("id AS a"), "s", "t", "append")
    store.write(spark.range(2).selectExpr("id AS a", "'x' AS b"), "s", "t", "append")
    frame = store.read(spark, "s", "t")
    assert frame.columns == ["a", "b"] and frame.count() == 5
    for path in glob.glob(f"{store.root}/s/t/*.parquet"):
        with open(path, "wb") as file:  # Spark would fail on the footers
            file.write(b"no parquet at all")
    assert store.read(spark, "s", "t").columns == ["a", "b"]


def test_columns_of_two_types_are_refused_before_anything_is_written(spark, store):
    store.write(spark.range(3).selectExpr("id AS a"), "s", "t", "append")
    with pytest.raises(ValueError, match="both bigint and string"):
        store.write(spark.range(3).selectExpr("'x' AS A"), "s", "t", "append")
    assert store.read(spark, "s", "t").count() == 3


def test_an_overwrite_replaces_the_schema(spark, store):
    store.write(spark.range(3).selectExpr("id AS a", "1 AS b"), "s", "t")
    store.write(spark.range(2).selectExpr("'x' AS a"), "s", "t")
    assert store.read(spark, "s", "t").dtypes == [("a", "string")]
    store.write(spark.range(2).selectExpr("'y' AS a", "id AS c"), "s", "t", "append")
    assert store.read(spark, "s", "t").columns == ["a", "c"] and store.read(spark, "s", "t").count() == 4
    names = [n for n in os.listdir(f"{store.root}/s/_schemas/t") if n[0] not in "._"]
    assert [json.load(open(f"{store.root}/s/_schemas/t/{n}"))["replaces"] for n in sorted(names)] == [True, False]


def test_partition_values_keep_their_type(spark, store):
    frame = spark.createDataFrame([("007", 1), ("010", 2)], "code string, n int")
    store.write(frame, "s", "t", partition_by=("code",))
    assert {r.code for r in store.read(spark, "s", "t").collect()} == {"007", "010"}


def test_files_of_others_are_read_and_registered_on_append(spark, store):
    spark.range(3).selectExpr("id AS a").write.parquet(f"{store.root}/s/t")
    spark.range(2).selectExpr("id AS b").write.mode("append").parquet(f"{store.root}/s/t")
    assert sorted(store.read(spark, "s", "t").columns) == ["a", "b"] and store.exists(spark, "s", "t")
    store.write(spark.range(1).selectExpr("id AS c"), "s", "t", "append")
    assert sorted(store.read(spark, "s", "t").columns) == ["a", "b", "c"]
    assert store.read(spark, "s", "t").count() == 6


def test_other_formats(spark, tmp_path):
    store = Store(str(tmp_path), fmt="json")
    store.write(spark.range(2).selectExpr("id AS a"), "s", "t", "append")
    store.write(spark.range(2).selectExpr("'z' AS b"), "s", "t", "append")
    assert store.read(spark, "s", "t").dtypes == [("a", "bigint"), ("b", "string")]
