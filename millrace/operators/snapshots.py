"""A materialised view as a keyed snapshot: unique-key check, difference to the last version, merge by key bucket."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, functions as F

from millrace.sources.tables import TableStore, Version

BUCKETS = 64
BUCKET = "key_bucket"


class DuplicateKeys(Exception):
    """The snapshot holds several rows for one key."""


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count. A null in a key never conflicts."""
    known = df
    for key in keys:
        known = known.where(F.col(key).isNotNull())
    return known.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def _digests(columns: Sequence[str]) -> list[Column]:
    """Two independent 64-bit digests of a row, which tell a missing value from any other."""
    parts = [x for c in columns for x in (F.col(c).isNull(), F.col(c))]
    return [F.xxhash64(F.lit(seed), *parts) for seed in (1, 2)]


def _compared(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, dict[str, Column], Column]:
    """The keys of both versions, and as columns over them how many rows changed by kind and how many the new version has."""
    first, second = _digests(new.columns)
    rows = old.select(*new.columns).select(*keys, first.alias("_first"), second.alias("_second"), F.lit(1).alias("_old"), F.lit(0).alias("_new")).unionByName(
        new.select(*keys, first.alias("_first"), second.alias("_second"), F.lit(0).alias("_old"), F.lit(1).alias("_new"))
    )
    per_row = rows.groupBy(*keys, "_first", "_second").agg(F.sum("_old").alias("_old"), F.sum("_new").alias("_new"))
    same = F.least("_old", "_new")
    per_key = per_row.groupBy(*keys).agg(
        F.sum(same).alias("_same"), F.sum(F.col("_old") - same).alias("_gone"), F.sum(F.col("_new") - same).alias("_come")
    )
    both = F.least("_gone", "_come")
    kinds = {"keep": F.col("_same"), "update": both, "delete": F.col("_gone") - both, "insert": F.col("_come") - both}
    return per_key, kinds, F.col("_same") + F.col("_come")


def snapshot_changes(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys of both versions with their ``change`` (insert, delete, update or keep) and its ``row_count``.

    A missing key part equals a missing one, and such a key may have several rows: equal rows of both versions
    are kept, of the others as many as both sides have are updates, and what is left over came or went. Rows are compared by
    a 128-bit digest, so keys and digests are all that is shuffled, and they are counted rather than joined, so a hot
    key shrinks before it moves.
    """
    per_key, kinds, _ = _compared(old, new, keys)
    pairs = F.array(*[F.struct(F.lit(k).alias("change"), n.alias("row_count")) for k, n in kinds.items()])
    return per_key.select(*keys, F.inline(pairs)).where("row_count > 0")


def _counts_and_duplicate(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> tuple[dict[str, int], Row | None]:
    """The rows changed by kind, and a key that the new version has several times, if any: one comparison gives both."""
    per_key, kinds, rows = _compared(old, new, keys)
    several = rows > 1
    for key in keys:
        several = several & F.col(key).isNotNull()
    sample = F.first(F.when(several, F.struct(*keys, rows.alias("row_count"))), ignorenulls=True)
    found = per_key.agg(sample.alias("_sample"), *[F.sum(n).alias(k) for k, n in kinds.items()]).first()
    return {k: found[k] or 0 for k in kinds}, found["_sample"]


def change_counts(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    return snapshot_changes(old, new, keys).groupBy("change").agg(F.sum("row_count").alias("row_count"))


def _staged(store: TableStore, schema: str, table: str, new: DataFrame, keys: Sequence[str], buckets: int) -> dict[str, dict]:
    """Writes the rows by key bucket to folders that no version names yet: path to bucket, rows and digest."""
    if BUCKET in new.columns:
        raise ValueError(f"a view cannot have a column named {BUCKET}")
    path = store.fresh_folder(schema, table)
    placed = new.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    placed.write.partitionBy(BUCKET).parquet(path)
    wide = [d.cast("decimal(20,0)") for d in _digests(new.columns)]
    stored = store.spark.read.schema(placed.schema).parquet(path)
    sums = stored.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("rows"), *[F.sum(d).cast("string").alias(f"d{i}") for i, d in enumerate(wide)])
    return {
        f"{path}/{BUCKET}={r[BUCKET]}": {"bucket": r[BUCKET], "rows": r["rows"], "digest": f"{r['d0']}:{r['d1']}"}
        for r in sums.collect()  # a row per bucket
    }


def refresh(
    store: TableStore, schema: str, table: str, new: DataFrame, keys: Sequence[str], buckets: int = BUCKETS
) -> dict[str, int]:
    """Merges a new state of a view into its table and returns how many rows changed, by kind.

    The table lies in buckets by the hash of the key. The new rows are computed once, into a folder of their own; a bucket whose
    number of rows and sum of row digests are those of the stored one keeps its files, and its new copy goes.
    Only the others are compared row by row, checked for duplicate keys and put in the table's next version; readers
    keep the old one until then, and a duplicate key leaves it in place.
    """
    before = store.version(schema, table)
    layout = {"keys": list(keys), "buckets": buckets}
    fresh = _staged(store, schema, table, new, keys, buckets)
    held: dict[str, dict] = {}
    if before is not None and before.layout == layout and before.schema.names == new.columns:
        held = dict(before.folders)
    unchanged = {(f["bucket"], f["rows"], f["digest"]): p for p, f in held.items()}
    kept, changed = {}, {}
    for path, known in fresh.items():
        old = unchanged.get((known["bucket"], known["rows"], known["digest"]))
        if old is None:
            changed[path] = known
        else:
            kept[old] = known
    version = Version(before.number + 1 if before else 1, new.schema, kept | changed, layout)
    rows = store.rows_of(version, list(changed))
    if before is None:
        sample = next(iter(duplicate_keys(rows, keys).take(1)), None)
        changes = {"insert": sum(f["rows"] for f in changed.values())}
    else:
        replaced = store.rows_of(before, [p for p in before.folders if p not in kept])
        changes, sample = _counts_and_duplicate(replaced.select(*new.columns), rows, keys)
    if sample is not None:
        raise DuplicateKeys(f"{schema}.{table} has several rows for {sample.asDict()}")
    counts = {**changes, "keep": changes.get("keep", 0) + sum(f["rows"] for f in kept.values())}
    store.commit(schema, table, version)
    for path in fresh.keys() - changed.keys():
        store.remove(path)
    return {kind: n for kind, n in counts.items() if n}
