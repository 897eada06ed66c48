"""Versions of stored tables: atomic replacement, merging refreshes, repeated batches, clean-up."""

import threading
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from harness import catalogue
from millrace import session
from millrace.operators import snapshots
from millrace.plans import runs
from millrace.sources import tables


@pytest.fixture
def store(spark):
    return tables.TableStore(spark, session.fresh_path(spark, "versions"), publish=False)


def files_of(spark, store, schema, table):
    """Path and time of every data file of the current version."""
    fs = store._fs(store.root)
    found = {}
    for folder in store.version(schema, table).folders:
        for status in fs.listStatus(store._path(folder)):
            if status.getPath().getName().startswith("part-"):
                found[status.getPath().toString()] = status.getModificationTime()
    return found


def test_readers_see_old_or_new_while_columns_change(spark, store):
    store.overwrite("s", "t", spark.range(3))
    errors, seen, stop = [], set(), threading.Event()

    def read():
        while not stop.is_set():
            try:
                rows = store.read("s", "t").collect()
                seen.add((len(rows), *rows[0].asDict()))
            except Exception as error:  # noqa: BLE001
                errors.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    for k in range(6):
        store.overwrite("s", "t", spark.range(5).withColumn(f"c{k % 2}", F.lit(k)) if k % 2 else spark.range(3))
    stop.set()
    reader.join()
    assert not errors and seen <= {(3, "id"), (5, "id", "c1")}


def test_a_crash_before_the_commit_leaves_the_old_version(spark, store, monkeypatch):
    store.overwrite("s", "t", spark.range(3))

    def crash(*_):
        raise OSError("lost")

    monkeypatch.setattr(tables.TableStore, "_rename", crash)
    with pytest.raises(OSError):
        store.overwrite("s", "t", spark.range(9).withColumn("x", F.lit(1)))
    monkeypatch.undo()
    assert (store.read("s", "t").columns, store.read("s", "t").count()) == (["id"], 3)
    store.overwrite("s", "t", spark.range(4))
    assert store.read("s", "t").count() == 4


def test_two_writers_cannot_commit_one_version(spark, store):
    store.overwrite("s", "t", spark.range(3))
    version = store.version("s", "t")
    late = replace(version, number=version.number + 1)
    store.overwrite("s", "t", spark.range(4))
    with pytest.raises(tables.Conflict):
        store.commit("s", "t", late)
    assert store.read("s", "t").count() == 4


def test_old_versions_go_after_the_stated_number(spark, store):
    for n in range(1, 7):
        store.overwrite("s", "t", spark.range(n))
    found = store.names(store.folder("s", "t"))
    assert len([f for f in found if f.startswith("v-")]) == store.keep == len(store._numbers("s", "t"))
    assert store.read("s", "t").count() == 6


def test_a_registered_folder_is_not_removed(spark, store):
    path = f"{store.root}/elsewhere"
    spark.range(2).write.parquet(path)
    store.register("s", "t", path)
    for n in range(5):
        store.overwrite("s", "t", spark.range(n))
    assert spark.read.parquet(path).count() == 2


def test_a_repeated_batch_replaces_itself(spark, store):
    for n, batch in ((2, "a"), (3, "b"), (4, "a"), (1, None), (1, None)):
        store.append("s", "log", spark.range(n), batch)
    assert store.read("s", "log").count() == 3 + 4 + 1 + 1


def test_many_appends_are_written_as_one(spark, store, monkeypatch):
    monkeypatch.setattr(tables, "MOST_FOLDERS", 3)
    for n in range(8):
        store.append("s", "log", spark.range(n, n + 1))
    assert sorted(r["id"] for r in store.read("s", "log").collect()) == list(range(8))
    assert len(store.version("s", "log").folders) <= 5


def test_tables_are_published_by_name(spark):
    named = tables.TableStore(spark, session.fresh_path(spark, "named"))
    try:
        named.overwrite("named_here", "t", spark.range(3))
        named.overwrite("named_here", "t", spark.range(2).withColumn("x", F.lit("a")))
        assert spark.table("named_here.t").columns == ["id", "x"] and spark.table("named_here.t").count() == 2
    finally:
        spark.sql("DROP DATABASE IF EXISTS named_here CASCADE")


def test_refresh_leaves_unchanged_buckets_alone(spark, store):
    view = spark.range(2000).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("m"), (F.col("id") % 7).cast("double").alias("v"))
    assert snapshots.refresh(store, "s", "v", view, ["k"]) == {"insert": 2000}
    before = files_of(spark, store, "s", "v")
    assert len(store.version("s", "v").folders) == 64
    buckets = {r["k"]: r["b"] for r in view.select("k", F.pmod(F.xxhash64("k"), F.lit(64)).alias("b")).collect()}
    one, other = "k5", next(k for k in buckets if buckets[k] != buckets["k5"])
    new = view.withColumn("v", F.when(F.col("k") == one, F.lit(None)).otherwise(F.col("v"))).where(F.col("k") != other)
    assert snapshots.refresh(store, "s", "v", new, ["k"]) == {"keep": 1998, "update": 1, "delete": 1}
    after = files_of(spark, store, "s", "v")
    touched = {p for p in before if before[p] != after.get(p)}
    assert {int(p.split("key_bucket=")[1].split("/")[0]) for p in touched} == {buckets[one], buckets[other]}
    assert len(store.version("s", "v").folders) == 64
    stored = store.read("s", "v")
    assert stored.exceptAll(new).isEmpty() and new.exceptAll(stored).isEmpty()
    # The same state again writes nothing, and the copies made for the comparison are gone.
    assert snapshots.refresh(store, "s", "v", new, ["k"]) == {"keep": 1999}
    assert files_of(spark, store, "s", "v") == after
    named = set(store.version("s", "v").folders)
    for folder in (f for f in store.names(store.folder("s", "v")) if f.startswith("v-")):
        held = {f"{store.folder('s', 'v')}/{folder}/{n}" for n in store.names(f"{store.folder('s', 'v')}/{folder}") if n.startswith("key_bucket")}
        assert held <= named | set(before_folders(store))


def before_folders(store):
    """Folders that the manifests kept for readers name."""
    found = set()
    for n in store._numbers("s", "v"):
        found |= set(tables.Version.of(n, store._read_text(store._manifest("s", "v", n))).folders)
    return found


def test_refresh_with_a_duplicate_in_a_changed_bucket(spark, store):
    view = spark.range(50).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    snapshots.refresh(store, "s", "v", view, ["k"])
    with pytest.raises(snapshots.DuplicateKeys):
        snapshots.refresh(store, "s", "v", view.union(view.where("k = 3").withColumn("v", F.lit(2))), ["k"])
    assert store.read("s", "v").count() == 50


def test_refresh_to_an_empty_view_and_back(spark, store):
    view = spark.range(50).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    snapshots.refresh(store, "s", "v", view, ["k"])
    assert snapshots.refresh(store, "s", "v", view.limit(0), ["k"]) == {"delete": 50}
    assert store.read("s", "v").count() == 0 and store.read("s", "v").columns == ["k", "v"]
    assert snapshots.refresh(store, "s", "v", view, ["k"]) == {"insert": 50}


def test_a_run_done_twice_leaves_one_record(spark, store):
    rows = spark.createDataFrame([(1, 2.0)], "id bigint, v double")
    outcomes = [runs.Outcome("job", "a", "b", ("t",), f"src_jira.{t}", t, rows) for t in ("x", "y")]
    runs.record(store, outcomes, catalogue.DELIVERY)
    first = {t: store.read("monitoring", t).collect() for t in (runs.LOGS, runs.COUNTS, runs.CHECKS)}
    runs.record(store, outcomes, catalogue.DELIVERY)
    for table, found in first.items():
        assert sorted(map(repr, store.read("monitoring", table).collect())) == sorted(map(repr, found))
    runs.record(store, outcomes[:1], catalogue.DELIVERY)
    assert store.read("monitoring", runs.LOGS).count() == 3


def test_refresh_compares_and_checks_keys_in_one_pass(spark, store, monkeypatch):
    """The rows of a merge were shuffled by key for the duplicate check and again for the comparison."""
    view = spark.range(50).selectExpr("id AS k", "id AS v")
    snapshots.refresh(store, "s", "v", view, ["k"])
    monkeypatch.setattr(snapshots, "duplicate_keys", None)
    nulls = view.union(spark.sql("SELECT cast(null AS bigint) AS k, 1L AS v UNION ALL SELECT null, 2L"))
    assert snapshots.refresh(store, "s", "v", nulls, ["k"]) == {"keep": 50, "insert": 2}
    with pytest.raises(snapshots.DuplicateKeys):
        snapshots.refresh(store, "s", "v", nulls.union(view.where("k = 3")), ["k"])
