import datetime as dt
import math
import random

import pytest
from pyspark.sql import Window, functions as F

from millrace.operators import calendar, intervals, joins, quantiles, runlog, snapshots, windows


def same_rows(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


# Calendar ----------------------------------------------------------------------------------------


def test_stored_day_spine(spark):
    days = calendar.time_series(spark)
    row = days.agg(F.count("*"), F.min("time_id"), F.max("time_id"), F.min("date"), F.max("date")).first()
    assert tuple(row) == (36525, 1, 36525, dt.date(2000, 1, 1), dt.date(2099, 12, 31))
    assert days.where("is_month_end").count() == 1200
    feb = days.where(F.col("date") == dt.date(2024, 2, 29)).first()
    assert (feb["month_name"], feb["quarter"], feb["is_month_end"]) == ("February ", 1, True)


def test_month_spine(spark):
    months = [r["month_year"] for r in calendar.month_spine(spark, dt.date(2026, 3, 1)).collect()]
    assert (len(months), months[0], months[-1]) == (61, "2021-12", "2026-12")


# Windows -----------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def months(spark):
    """One month holds a third of the rows; one is missing."""
    rng = random.Random(1)
    rows = [
        ("2020-02" if i % 3 == 0 else rng.choice(["2020-01", "2020-03", "2020-07", None]), f"m{i}", float(i % 97))
        for i in range(6000)
    ]
    return spark.createDataFrame(rows, "month string, member string, v double").repartition(7)


@pytest.mark.parametrize("block_rows", [4, 50, 100_000])
def test_sequential_window_equals_the_plain_one(months, block_rows):
    fast = windows.sequential_window(
        months,
        ["month"],
        ["member"],
        3,
        lambda w: {"ma": F.avg("v").over(w.rowsBetween(-3, 0)), "before": F.lag("v").over(w)},
        block_rows=block_rows,
    )
    plain = Window.orderBy(F.col("month").asc_nulls_last(), F.md5("member"), "member")
    slow = months.withColumns(
        {"ma": F.avg("v").over(plain.rowsBetween(-3, 0)), "before": F.lag("v").over(plain)}
    )
    assert same_rows(fast, slow)


def test_sequential_window_needs_room_for_its_frame(months):
    with pytest.raises(ValueError):
        windows.sequential_window(months, ["month"], ["member"], 3, lambda w: {}, block_rows=3)


def test_sequential_window_leaves_no_data_window_in_one_task(months):
    fast = windows.sequential_window(
        months, ["month"], ["member"], 3, lambda w: {"ma": F.avg("v").over(w.rowsBetween(-3, 0))}
    )
    plan = fast._jdf.queryExecution().executedPlan().toString()
    # The only single-task step sums up the counts per bucket.
    assert plan.count("SinglePartition") == 1
    assert "sum(_rows" in plan


def test_carry_forward_forms_agree_without_ties(spark):
    rows = [(f"m{i % 5}", f"2020-{i // 5 + 1:02d}", float(i) if i % 4 == 0 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "member string, month string, v double")
    island = windows.carry_forward_by_island(df, "v", ["member"], "month", "filled")
    direct = df.withColumn("filled", windows.carry_forward("v", ["member"], ["month"]))
    assert same_rows(island, direct)


def test_carry_forward_shares_values_among_ties(spark):
    df = spark.createDataFrame(
        [("a", "2020-01", None), ("a", "2020-02", 1.0), ("a", "2020-02", None), ("a", "2020-03", None)],
        "member string, month string, v double",
    )
    filled = windows.carry_forward_by_island(df, "v", ["member"], "month", "filled")
    assert sorted((r["month"], r["filled"]) for r in filled.collect()) == [
        ("2020-01", None),
        ("2020-02", 1.0),
        ("2020-02", 1.0),
        ("2020-03", 1.0),
    ]


# Intervals ---------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def spans(spark):
    rng = random.Random(2)
    day = lambda: dt.date(2003, 1, 1) + dt.timedelta(rng.randrange(9000))
    rows = [
        (
            f"g{rng.randrange(3)}" if rng.random() < 0.9 else None,
            f"s{rng.randrange(120)}" if rng.random() < 0.9 else None,
            day() if rng.random() < 0.95 else None,
            day() if rng.random() < 0.6 else None,
        )
        for _ in range(400)
    ]
    rows += [
        ("g0", "leaver-nov", dt.date(2010, 1, 1), dt.date(2015, 11, 30)),
        ("g0", "leaver-dec1", dt.date(2010, 1, 1), dt.date(2015, 12, 1)),
        ("g0", "leaver-dec31", dt.date(2010, 1, 1), dt.date(2015, 12, 31)),
    ]
    return spark.createDataFrame(rows, "g string, s string, d0 date, d1 date")


@pytest.mark.parametrize("yearly", [True, False])
def test_span_join_equals_the_range_join(spark, spans, yearly):
    as_of, first = dt.date(2024, 12, 31), dt.date(2005, 1, 1)
    days = calendar.time_series(spark).where("is_month_end").where(F.col("date").between(first, as_of))
    ends = days.where("month = 12").select("date") if yearly else days.select("date")
    still_there = F.col("d1").isNull() | (F.col("d1") >= F.trunc("date", "month"))
    fast = intervals.span_by_calendar(spans, ends, "d0", "d1", as_of, first, yearly=yearly).where(still_there)
    slow = spans.join(ends, (F.col("d0") <= F.col("date")) & still_there)
    assert fast.count() > 0 and same_rows(fast, slow)
    assert "NestedLoop" not in fast._jdf.queryExecution().executedPlan().toString()
    if yearly:
        stayed = {r["s"] for r in fast.where(F.col("date") == dt.date(2015, 12, 31)).collect()}
        assert "leaver-nov" not in stayed and {"leaver-dec1", "leaver-dec31"} <= stayed


def test_distinct_per_month_equals_listing_every_month(spark, spans):
    months = spans.where("d0 is not null").select(
        "g",
        "s",
        intervals.month_number(F.col("d0")).alias("a"),
        F.coalesce(intervals.month_number(F.col("d1")), F.lit(2024 * 12)).alias("b"),
    )
    fast = intervals.distinct_per_month(months, ["g"], "s", "a", "b", "n")
    slow = (
        months.where("a <= b")
        .withColumn("month", F.explode(F.sequence("a", "b")))
        .groupBy("g", "month")
        .agg(F.countDistinct("s").alias("n"))
    )
    assert same_rows(fast, slow)


# Joins -------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def hot_fact(spark):
    """A third of the rows share one key, some have none, some match nothing."""
    key = (
        F.when(F.col("id") % 3 == 0, F.lit(7))
        .when(F.col("id") % 50 == 1, F.lit(None))
        .otherwise(F.col("id") % 400)
        .cast("int")
    )
    return spark.range(9000).select("id", key.alias("k"))


@pytest.fixture
def small_partitions(spark):
    """Limits under which the small test tables count as skewed, without broadcasts."""
    settings = {
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2000",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2000",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


@pytest.mark.parametrize("how", joins.SPLITTABLE_JOINS)
def test_splittable_join_equals_the_plain_join(spark, hot_fact, how):
    # The other side holds the key in another width and twice for one value.
    other = spark.range(300).union(spark.range(7, 8)).select(
        F.col("id").alias("k"), (F.col("id") * 10).alias("v")
    )
    assert same_rows(joins.splittable_join(hot_fact, other, ["k"], how), hot_fact.join(other, "k", how))


@pytest.mark.parametrize("how", joins.SPLITTABLE_JOINS)
def test_hot_partition_is_split_against_sums(spark, hot_fact, how, small_partitions):
    fact = hot_fact.repartition(16)
    sums = spark.range(30000).groupBy((F.col("id") % 300).cast("int").alias("k")).count()

    def is_split(df):
        df.collect()
        return "skew=true" in df._jdf.queryExecution().executedPlan().toString()

    assert not is_split(fact.join(sums, "k", how))
    assert is_split(joins.splittable_join(fact, sums, ["k"], how))


def test_splittable_join_refuses_joins_it_cannot_split(hot_fact):
    with pytest.raises(ValueError):
        joins.splittable_join(hot_fact, hot_fact, ["k"], "full")


def test_left_join_with_hot_right_side(spark, hot_fact):
    left = spark.range(0, 500).select(F.when(F.col("id") != 9, F.col("id").cast("int")).alias("k"), F.lit("x").alias("l"))
    plain = left.join(hot_fact, "k", "left")
    for rows in (1, joins.HEAVY_ROWS):
        assert same_rows(joins.left_join_hot_right(left, hot_fact, ["k"], rows=rows), plain)
    repeated = left.union(left.where("k = 7"))
    assert same_rows(joins.left_join_hot_right(repeated, hot_fact, ["k"], salts=5, rows=1), repeated.join(hot_fact, "k", "left"))


def test_heavy_keys(spark, hot_fact):
    assert joins.heavy_keys(hot_fact, ["k"], rows=1000) == ['{"k":7}']
    assert joins.heavy_keys(hot_fact, ["k"]) == [] and joins.heavy_keys(hot_fact.limit(0), ["k"]) == []
    two = hot_fact.select("k", F.when(F.col("id") % 2 == 0, "a").alias("b"))
    assert joins.heavy_keys(two, ["k", "b"], rows=500) == ['{"k":7,"b":"a"}']


def test_hot_right_rows_part(spark, hot_fact, small_partitions):
    """Both sides are read once, and no task of the join holds a third of the rows."""
    left = spark.range(0, 500).select(F.col("id").cast("int").alias("k"), F.lit("x").alias("l"))
    joined = joins.left_join_hot_right(left, hot_fact, ["k"], rows=1)
    assert joined._jdf.queryExecution().executedPlan().toString().count("Range (") == 2
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        per_task = [r["n"] for r in joined.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(per_task) < 0.2 * hot_fact.count()


# Quantiles ---------------------------------------------------------------------------------------


def _linear(values, share):
    ordered = sorted(values)
    position = share * (len(ordered) - 1)
    low = math.floor(position)
    high = min(low + 1, len(ordered) - 1)
    return ordered[low] + (ordered[high] - ordered[low]) * (position - low)


@pytest.mark.parametrize(
    "make",
    [
        lambda r: r.uniform(-5, 5),
        lambda r: 10 ** r.uniform(-300, 300),
        lambda r: float(r.randrange(3)),
        lambda r: 7.5 if r.random() < 0.9 else r.gauss(0, 1e9),
        lambda r: r.choice([-1.7e308, 1.7e308]) * r.random(),
    ],
    ids=["uniform", "wide", "few values", "one hot value", "full range"],
)
def test_exact_quantiles(spark, make):
    rng = random.Random(3)
    values = [make(rng) for _ in range(3001)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "v double")
    shares = [0.0, 0.05, 0.5, 0.95, 1.0]
    found = quantiles.exact_quantiles(df, ["v"], shares)["v"]
    assert found == pytest.approx([_linear(values, s) for s in shares], rel=1e-12)


def test_quantiles_of_several_columns_at_once(spark):
    df = spark.range(101).select(
        "id", (F.col("id") * 2.5).alias("w"), F.lit(None).cast("double").alias("empty"), F.lit(4).alias("same")
    )
    found = quantiles.exact_quantiles(df, ["id", "w", "empty", "same"], [0.25, 0.5])
    assert found == {"id": [25.0, 50.0], "w": [62.5, 125.0], "empty": [None, None], "same": [4.0, 4.0]}


# Snapshots and run log ---------------------------------------------------------------------------


def test_snapshot_changes(spark):
    old = spark.createDataFrame([("a", 1, 1.0), ("b", 1, None), ("c", 1, 2.0)], "k string, m int, v double")
    new = spark.createDataFrame([("a", 1, 1.5), ("b", 1, None), ("d", 1, 2.0)], "k string, m int, v double")
    found = snapshots.snapshot_changes(old, new, ["k", "m"]).collect()
    assert {r["k"]: r["change"] for r in found} == {"a": "update", "b": "keep", "c": "delete", "d": "insert"}


def test_snapshot_changes_pair_missing_keys(spark):
    schema = "k string, m int, v double"
    old = [("a", None, 1.0), ("a", None, 1.0), ("a", None, 2.0), (None, None, None), ("b", 1, 5.0)]
    new = [("a", None, 1.0), ("a", None, 2.0), ("a", None, 3.0), ("a", None, 4.0), (None, None, None), ("b", 1, 5.0)]
    counts = lambda o, n: {
        r["change"]: r["row_count"]
        for r in snapshots.change_counts(spark.createDataFrame(o, schema), spark.createDataFrame(n, schema), ["k", "m"]).collect()
    }
    assert counts(old, new) == {"keep": 4, "update": 1, "insert": 1}
    assert counts(new, old) == {"keep": 4, "update": 1, "delete": 1}
    assert counts([], []) == {}


def test_duplicate_keys_ignore_missing_parts(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 1), (None, 1), ("b", 2)], "k string, m int")
    assert [tuple(r) for r in snapshots.duplicate_keys(df, ["k", "m"]).collect()] == [("a", 1, 2)]


def test_row_count_deltas(spark):
    runs = spark.createDataFrame([("t", 1, 10), ("t", 2, 25), ("t", 3, 20)], "table_name string, run_ts int, total_rows long")
    found = runlog.row_count_deltas(runs).orderBy("run_ts").collect()
    assert [(r["previous_rows"], r["new_rows"]) for r in found] == [(0, 10), (10, 15), (25, -5)]


def test_log_row_stores_several_sources_as_json(spark):
    now = dt.datetime(2024, 1, 1)
    several = runlog.log_row(spark, now, job_name="j", source_table=["a", "b"], status=runlog.SUCCESS).first()
    single = runlog.log_row(spark, now, source_table="a").first()
    assert (several["source_table"], several["created_time"], single["source_table"]) == ('["a","b"]', now, "a")
    assert runlog.mart_target("hr", "dim_branches") == "hr_dtm-dim_branches"


def test_expired_objects(spark):
    names = ["x-20240101.gz", "x-20240102.gz", "x-20240103.gz", "x-20241399.gz", "x.gz", "x-00000101", "20231231-20240109"]
    objects = spark.createDataFrame([(n,) for n in names], "object_name string")
    found = runlog.expired_objects(objects, dt.date(2024, 1, 3)).collect()
    assert sorted(r["object_name"] for r in found) == ["20231231-20240109", "x-20240101.gz"]


def test_load_check(spark):
    some, none = spark.range(3), spark.range(0)
    assert tuple(runlog.load_check({"a": some, "b": none}).first()) == (3, True)
    assert tuple(runlog.load_check({"b": none}).first()) == (0, False)


def test_new_tables(spark):
    remote = spark.createDataFrame(
        [("s", "a", "BASE TABLE"), ("s", "b", "BASE TABLE"), ("s", "c", "VIEW"), ("t", "d", "BASE TABLE")],
        "table_schema string, table_name string, table_type string",
    )
    local = spark.createDataFrame([("a",)], "table_name string")
    assert {r["table_name"] for r in runlog.new_tables(remote, local).collect()} == {"b", "d"}
    assert {r["table_name"] for r in runlog.new_tables(remote, local, "s").collect()} == {"b"}


def test_repeatable_sample(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("k"))
    first = {r["k"] for r in runlog.repeatable_sample(df.repartition(3), "k", 20).collect()}
    assert len(first) == 20 and first == {r["k"] for r in runlog.repeatable_sample(df, "k", 20).collect()}


def test_quantiles_need_few_rounds(spark, monkeypatch):
    rounds = []
    narrow = quantiles._narrow
    monkeypatch.setattr(quantiles, "_narrow", lambda *a: rounds.append(1) or narrow(*a))
    wide = spark.range(5000).select(F.pow(F.lit(10.0), F.col("id") % 600 - 300).alias("v"))
    quantiles.exact_quantiles(wide, ["v"], [0.05, 0.95])
    assert len(rounds) <= 6


def test_content_digest_sees_cells_and_not_their_order(spark):
    schema = "a int, b string, c double, d timestamp_ntz, e array<int>"
    rows = [(1, "x", 0.5, dt.datetime(2024, 1, 2, 3, 4, 5, 6), [1, 2]), (None, None, None, None, None), (1, "", -0.0, None, [])]
    digest = lambda r, order="abcde": runlog.content_digest(spark.createDataFrame(r, schema).select(*order), "t").first()
    first = digest(rows)
    assert tuple(first)[:2] == ("t", 3) and first == digest(rows[::-1], "edcba")
    others = [rows[:2], [*rows, rows[0]], [(2, *rows[0][1:]), *rows[1:]], [rows[0], (None, "", None, None, None), rows[2]], [(1, "x", 0.500001, *rows[0][3:]), *rows[1:]]]
    assert len({digest(o)["content_digest"] for o in others} | {first["content_digest"]}) == 6
    assert tuple(digest([])) == ("t", 0, "0")


def test_content_digest_sums_longs(spark):
    """Decimals per row took half the time of the digest; the digest itself is the one that decimals gave."""
    cells = [0.5e-6, -0.5e-6, 1.4999995, -2.5e-6, 3e9, 4503599627.5, 1e30, -1e25, 0.0, -0.0, None]
    df = spark.createDataFrame([(c,) for c in cells], "c double")
    cell = F.round(F.col("c") * 1_000_000).cast("decimal(38,0)").cast("string")
    row = F.md5(F.concat_ws("\x1f", F.coalesce(F.concat(F.lit("="), cell), F.lit("-"))))
    number = F.conv(F.substring(row, 1, 15), 16, 10).cast("decimal(20,0)")
    found = runlog.content_digest(df, "t")
    assert tuple(found.first()) == ("t", len(cells), str(df.agg(F.sum(number)).first()[0]))
    sums = [line for line in found._jdf.queryExecution().executedPlan().toString().splitlines() if "partial_sum(" in line]
    assert sums and not any("decimal(20,0)" in line for line in sums)


def test_quantiles_widen_a_bracket_that_missed(spark, monkeypatch):
    """Values stay exact even if every bracket lies wrong."""
    right = quantiles._brackets
    monkeypatch.setattr(quantiles, "_brackets", lambda *a: [quantiles.replace(b, low=40.0, high=41.0) for b in right(*a)])
    df = spark.range(101).select(F.col("id").cast("double").alias("v"))
    assert quantiles.exact_quantiles(df, ["v"], [0.0, 0.105, 0.4, 0.9, 1.0])["v"] == pytest.approx([0.0, 10.5, 40.0, 90.0, 100.0])


def test_quantiles_scan_the_table_three_times(spark, tmp_path):
    """Ten columns: sketches, counts and the values within the brackets; what follows reads the checkpointed values."""
    wide = spark.range(30_000).select(*[(F.xxhash64("id", F.lit(i)) % 10_007).cast("double").alias(f"c{i}") for i in range(10)])
    wide.write.parquet(str(tmp_path / "wide"))
    tracked = spark.read.parquet(str(tmp_path / "wide"))
    scans = []
    real = {n: getattr(quantiles, n) for n in ("column_ranges", "_counted", "_values_within", "_counted_again", "_at_infinity")}
    for name, function in real.items():
        def counted(*a, _name=name, _function=function, **k):
            if a and a[0] is tracked and (len(a) < 2 or a[1]):
                scans.append(_name)
            return _function(*a, **k)

        setattr(quantiles, name, counted)
    try:
        found = quantiles.exact_quantiles(tracked, tracked.columns, [0.05, 0.95])
    finally:
        for name, function in real.items():
            setattr(quantiles, name, function)
    assert scans == ["column_ranges", "_counted", "_values_within"]
    for c in tracked.columns:
        assert found[c] == pytest.approx([_linear([r[c] for r in tracked.select(c).collect()], s) for s in (0.05, 0.95)])


def test_values_within_brackets_are_few(spark):
    df = spark.range(200_000).select(F.xxhash64("id").cast("double").alias("v"))
    ranges = quantiles.column_ranges(df, ["v"])
    brackets = quantiles._counted(df, quantiles._brackets(df, ranges, ["v"], [0.05, 0.95]))
    assert sum(b.rows for b in brackets) < 0.03 * 200_000
    assert "Generate" not in df.agg(quantiles.sketch("v"))._jdf.queryExecution().executedPlan().toString()
