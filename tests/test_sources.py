import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace import session
from millrace.operators import snapshots
from millrace.plans import registry, warehouse  # noqa: F401 - registers models
from millrace.sources import cleaning, readers, staging, tables

LOAD_TS = dt.datetime(2024, 6, 1, 12, 30)


@pytest.fixture
def store(spark):
    return tables.TableStore(spark, session.fresh_path(spark, "store"))


@pytest.fixture
def schema(spark):
    name = f"s_{uuid.uuid4().hex[:8]}"
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")


# Readers -----------------------------------------------------------------------------------------


def test_jdbc_options():
    whole = readers.jdbc_options("jdbc:x", "select 1")
    assert whole["query"] == "select 1" and "dbtable" not in whole
    split = readers.jdbc_options("jdbc:x", "select 1", "id", (0, 90), 9, extra={"user": "u"})
    assert split["dbtable"] == "(select 1) source_rows" and "query" not in split
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"]) == ("id", "0", "90")
    assert (split["numPartitions"], split["user"]) == ("9", "u")
    with pytest.raises(ValueError):
        readers.jdbc_options("jdbc:x", "select 1", "id")


def test_hash_predicates_cover_every_row_once(spark):
    rows = spark.range(100).selectExpr("if(id % 10 = 0, null, id) k")
    rows.createOrReplaceTempView("rows_to_split")
    counts = [
        spark.sql(f"select count(*) n from rows_to_split where {p}").first()["n"]
        for p in readers.hash_predicates("abs(k)", 4)
    ]
    assert sum(counts) == 100 and counts[0] >= 10
    signed = [
        spark.sql(f"select count(*) n from rows_to_split where {p}").first()["n"]
        for p in readers.hash_predicates("50 - k", 4)
    ]
    assert sum(signed) == 100


def test_sql_errors_are_raised(spark):
    with pytest.raises(Exception, match="no_such_table"):
        readers.extract_sql_data(spark, "select * from no_such_table")


@pytest.mark.parametrize("kind", ["int", "string", "date"])
def test_split_parts_hold_every_row_once_and_are_alike(spark, kind):
    """A third of the rows have one value, the others crowd at one end, some have none."""
    n = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.floor(F.exp(F.xxhash64("id") % 1000 / 150)) + 2000).cast("int")
    keys = {"int": n, "string": F.concat(F.lit("it's "), F.lpad(n.cast("string"), 9, "0")), "date": F.date_add(F.lit(dt.date(2000, 1, 1)), n)}
    rows = spark.range(40_000).select("id", keys[kind].alias("k"))
    rows.createOrReplaceTempView("split_rows")
    split = readers.Split("k", 9, "hash(id)")
    predicates = readers.split_predicates(split, readers.key_sample(rows, "k", split))
    counts = [spark.sql(f"SELECT * FROM split_rows WHERE {p}").count() for p in predicates]
    assert sum(counts) == 40_000 and len(counts) >= 8
    assert max(counts) <= 2 * min(counts), counts
    whole = readers.extract_sql_split(spark, "SELECT * FROM split_rows", split)
    assert whole.count() == 40_000 and whole.distinct().count() == 40_000
    one = readers.Split("k", 9)
    assert sum(spark.sql(f"SELECT * FROM split_rows WHERE {p}").count() for p in readers.split_predicates(one, readers.key_sample(rows, "k", one))) == 40_000


def test_split_of_an_empty_table(spark):
    spark.range(0).createOrReplaceTempView("no_rows")
    assert readers.extract_sql_split(spark, "SELECT * FROM no_rows", readers.Split("id", 4, "id")).count() == 0
    assert readers.split_predicates(readers.Split("id", 4), []) == ["1 = 1"]


def test_documents_keep_their_declared_schema(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"_id": {"$oid": "65a"}, "n": 1, "extra": 2}\n{"_id": {"$oid": "65b"}}\n')
    schema = "_id struct<`$oid`: string>, n int"
    df = readers.extract_document_data(spark, str(tmp_path), schema, surplus="drop")
    assert sorted((r["_id"]["$oid"], r["n"]) for r in df.collect()) == [("65a", 1), ("65b", None)]
    with pytest.raises(readers.UndeclaredFields, match="extra"):
        readers.extract_document_data(spark, str(tmp_path), schema)
    whole = readers.extract_document_data(spark, str(tmp_path), f"{schema}, extra int")
    assert sorted((r["_id"]["$oid"], r["extra"]) for r in whole.collect()) == [("65a", 2), ("65b", None)]


def test_undeclared_fields_of_whole_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"n": 1,\n "x": {"n": 2}}, {"n": null}, {"x": null}]')
    found = readers.undeclared_fields(spark, str(tmp_path), "n int", multi_line=True)
    assert [tuple(r) for r in found.collect()] == [("x", 2)]


def test_surplus_fields_at_any_depth(spark, tmp_path):
    lines = [
        '{"_id": {"$oid": "1"}, "a": {"x": 1, "y": [{"q": 1, "new": {"deep": [1, null]}}]}, "m": {"k": {"v": 1, "w": 2}}, "t": {"any": 1}}',
        '{"_id": {"$oid": "2"}, "a": {"x": 2, "late": "s"}, "s": "text", "mixed": {"o": 1}}',
        '{"_id": {"$oid": "3"}, "mixed": 7}',
    ]
    (tmp_path / "a.json").write_text("\n".join(lines))
    schema = "_id struct<`$oid`: string>, a struct<x: int, y: array<struct<q: int>>>, m map<string, struct<v: int>>, t string, mixed struct<o: int>"
    declared = spark.createDataFrame([], schema).schema
    found = readers.document_schema(spark, str(tmp_path))
    assert sorted(readers.surplus_paths(declared, found)) == ["a.late", "a.y[].new", "m.*.w", "mixed", "s"]
    with pytest.raises(readers.UndeclaredFields, match=r"a\.y\[\]\.new"):
        readers.extract_document_data(spark, str(tmp_path), schema)
    rows = {r["_id"]["$oid"]: r for r in readers.extract_document_data(spark, str(tmp_path), schema, surplus="stage").collect()}
    assert rows["1"]["a"]["y"][0].asDict() == {"q": 1, "new": '{"deep": [1, null]}'} and rows["1"]["t"] == '{"any": 1}'
    assert rows["1"]["m"]["k"].asDict() == {"v": 1, "w": "2"} and rows["1"]["a"]["late"] is None
    assert (rows["2"]["a"]["late"], rows["2"]["s"], rows["2"]["mixed"], rows["3"]["mixed"]) == ("s", "text", '{"o": 1}', "7")


def test_an_empty_export_has_no_fields(spark, tmp_path):
    (tmp_path / "a.json").write_text("")
    assert readers.document_schema(spark, str(tmp_path)) == StructType()
    assert readers.extract_document_data(spark, str(tmp_path), "n int").count() == 0


def test_broken_documents_fail_the_read(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"n": 1\n')
    with pytest.raises(Exception):
        readers.extract_document_data(spark, str(tmp_path), "n int").collect()


def test_missing_connector_is_named(spark):
    with pytest.raises(Exception, match="mongodb"):
        readers.extract_collection_data(spark, "mongodb://nowhere", "d", "c", "n int")


# Cleaning ----------------------------------------------------------------------------------------

DOCUMENT = (
    "_id struct<`$oid`: string>, owner struct<ref: struct<`$oid`: string>, tags: array<struct<`$oid`: string>>>, "
    "by_name map<string, struct<`$oid`: string>>, plain string, n int"
)


@pytest.fixture
def documents(spark):
    return spark.createDataFrame(
        [
            ((("1"),), ((("2"),), [("3",), None]), {"k": ("4",)}, "a\0b", 5),
            (None, None, None, None, None),
        ],
        DOCUMENT,
    )


def test_object_ids_become_text_at_any_depth(documents):
    flat = cleaning.convert_object_ids(documents)
    assert [f.dataType.simpleString() for f in flat.schema] == [
        "string",
        "struct<ref:string,tags:array<string>>",
        "map<string,string>",
        "string",
        "int",
    ]
    first, empty = flat.collect()
    assert (first["_id"], first["owner"]["ref"], first["owner"]["tags"]) == ("1", "2", ["3", None])
    assert first["by_name"] == {"k": "4"}
    assert all(v is None for v in empty)


def test_nested_cells_become_json_and_nul_goes_last(documents):
    cleaned = cleaning.strip_nul(cleaning.serialize_complex_types(cleaning.convert_object_ids(documents)))
    first, empty = cleaned.collect()
    assert first["owner"] == '{"ref":"2","tags":["3",null]}'
    assert (first["by_name"], first["plain"], first["n"]) == ('{"k":"4"}', "ab", 5)
    assert all(v is None for v in empty)


def test_cleaning_follows_the_source(spark):
    df = spark.createDataFrame([("a\0b",)], "x string")
    kept = staging.clean(df, staging.SOURCES["facts"], LOAD_TS).first()
    stripped = staging.clean(df, staging.SOURCES["tracker"], LOAD_TS).first()
    assert (kept["x"], stripped["x"]) == ("a\0b", "ab")
    assert kept["etl_datetime"] == LOAD_TS


def test_every_source_table_is_listed():
    assert [len(s.tables) for s in staging.SOURCES.values()] == [17, 7, 2]


# Tables ------------------------------------------------------------------------------------------


def test_reload_replaces_the_rows(spark, store, schema):
    source = staging.Source(schema=schema, tables=("t",))
    for rows in (range(5), range(3)):
        data = spark.createDataFrame([(i, f"v{i}") for i in rows], "id int, v string")
        loaded = staging.load_table(store, source, "t", lambda _: data, LOAD_TS)
    assert sorted(r["id"] for r in loaded.collect()) == [0, 1, 2]
    assert sorted(r["id"] for r in store.read(schema, "stg_t").collect()) == [0, 1, 2]


def test_first_load_fixes_the_columns(spark, store, schema):
    source = staging.Source(schema=schema, tables=("t",))
    first = spark.createDataFrame([(1, "a")], "id int, v string")
    staging.load_table(store, source, "t", lambda _: first, LOAD_TS)
    # Another order is fine, another column is not; the old rows survive the refused load.
    staging.load_table(store, source, "t", lambda _: first.select("v", "id"), LOAD_TS)
    for changed in (first.withColumn("w", F.lit(1)), first.withColumn("id", F.col("id").cast("long"))):
        with pytest.raises(tables.SchemaMismatch):
            staging.load_table(store, source, "t", lambda _, c=changed: c, LOAD_TS)
    assert store.read(schema, "stg_t").count() == 1


def test_failed_write_keeps_the_old_rows(spark, store, schema):
    store.overwrite(schema, "t", spark.range(4))
    with pytest.raises(Exception):
        store.overwrite(schema, "t", spark.range(9).select(F.raise_error(F.lit("lost")).cast("long").alias("id")))
    assert store.read(schema, "t").count() == 4


def test_models_may_change_their_columns(spark, store, schema):
    store.overwrite(schema, "t", spark.range(4))
    assert store.overwrite(schema, "t", spark.range(2).select("id", F.lit(1).alias("x"))).columns == ["id", "x"]


def test_a_table_can_be_rebuilt_from_itself(spark, store, schema):
    store.overwrite(schema, "t", spark.range(4))
    store.overwrite(schema, "t", store.read(schema, "t").where("id > 1"))
    assert store.read(schema, "t").count() == 2


def test_append_grows(spark, store, schema):
    for n in (2, 3):
        store.append(schema, "log", spark.range(n))
    assert store.read(schema, "log").count() == 5
    with pytest.raises(tables.SchemaMismatch):
        store.append(schema, "log", spark.range(1).select(F.lit("x").alias("id")))


def test_sync_registers_only_missing_tables(spark, store, schema):
    old, new = store.write_version("files", "old", spark.range(1)), store.write_version("files", "new", spark.range(2))
    store.overwrite(schema, "old", spark.range(7))
    listing = spark.createDataFrame(
        [
            ("far", "old", "BASE TABLE", old),
            ("far", "new", "BASE TABLE", new),
            ("far", "shown", "VIEW", new),
            ("else", "other", "BASE TABLE", new),
        ],
        "table_schema string, table_name string, table_type string, location string",
    )
    assert store.sync(schema, listing, "far") == ["new"]
    assert store.sync(schema, listing, "far") == []
    assert (store.read(schema, "old").count(), store.read(schema, "new").count()) == (7, 2)


def test_batch_load_reports_each_table(spark, store, schema, monkeypatch):
    sources = {"s": staging.Source(schema=schema, tables=("good", "bad", "fine"))}
    monkeypatch.setattr(staging, "SOURCES", sources)

    def extract(_, table):
        if table == "bad":
            raise OSError("source down")
        return spark.range(3)

    loaded = staging.load_all(store, extract, LOAD_TS)
    assert isinstance(loaded["s", "bad"], OSError)
    assert [loaded["s", t].count() for t in ("good", "fine")] == [3, 3]


def test_default_schema():
    assert tables.target_schema("hr", "public") == "hr"
    assert tables.target_schema(None, "public") == "public"


# Materialised view -------------------------------------------------------------------------------


def test_refresh_counts_changes_and_keeps_the_key_unique(spark, store, schema):
    view = lambda rows: spark.createDataFrame(rows, "k string, m string, v double")
    keys = ["k", "m"]
    assert snapshots.refresh(store, schema, "v", view([("a", "1", 1.0), ("b", "1", 2.0)]), keys) == {"insert": 2}
    changed = view([("a", "1", 1.0), ("b", "1", 3.0), ("c", "1", None)])
    assert snapshots.refresh(store, schema, "v", changed, keys) == {"keep": 1, "update": 1, "insert": 1}
    with pytest.raises(snapshots.DuplicateKeys, match="'a'"):
        snapshots.refresh(store, schema, "v", view([("a", "1", 1.0), ("a", "1", 2.0)]), keys)
    assert store.read(schema, "v").count() == 3


# Registry ----------------------------------------------------------------------------------------


def test_inputs_come_first():
    from millrace.plans import delivery, free_effort, hr  # noqa: F401

    order = registry.run_order(["jira.mview_member_free_effort", "hr.fct_hrm_employees"])
    for name in order:
        for needed in registry.MODELS[name].inputs:
            assert needed not in registry.MODELS or order.index(needed) < order.index(name)
    assert {"dwh.users", "jira.dim_members", "jira.fct_worklog"} <= set(order)


def test_circular_models_are_refused(monkeypatch):
    build = lambda inputs, p: None
    circle = {
        "a.x": registry.Model("x", ("a.y",), build, "a"),
        "a.y": registry.Model("y", ("a.x",), build, "a"),
    }
    monkeypatch.setattr(registry, "MODELS", circle)
    with pytest.raises(ValueError, match="a.x > a.y > a.x"):
        registry.run_order(["a.x"])


def test_shared_dir_is_the_configured_one(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert session.shared_dir(spark) == configured.rstrip("/")
    assert session.fresh_path(spark, "x") != session.fresh_path(spark, "x")


class FakeSession:
    """Just enough of a session to ask for its settings."""

    def __init__(self, **settings):
        self.settings = {"spark.sql.shuffle.partitions": "200", **settings}
        self.conf = self
        self.sparkContext = type("Context", (), {"defaultParallelism": 8000})

    def get(self, key, default=None):
        return self.settings.get(key, default)

    def set(self, key, value):
        self.settings[key] = value


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(FakeSession(**{"spark.master": "yarn"}))
    named = FakeSession(**{"spark.master": "yarn", "spark.checkpoint.dir": "hdfs:///shared/"})
    assert session.shared_dir(named) == "hdfs:///shared"
    local = FakeSession(**{"spark.master": "local[2]"})
    assert session.shared_dir(local) == session.shared_dir(local)


def test_shuffles_grow_with_the_cluster():
    wide = session.tune(FakeSession(**{"spark.master": "yarn"}))
    assert wide.get(session.INITIAL_PARTITIONS) == "24000"
    chosen = session.tune(FakeSession(**{"spark.master": "yarn", session.INITIAL_PARTITIONS: "5"}))
    assert chosen.get(session.INITIAL_PARTITIONS) == "5"
    assert session.tune(FakeSession(**{"spark.master": "local[8]"})).get(session.INITIAL_PARTITIONS) is None
