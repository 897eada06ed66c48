"""Exact duplicates by deterministic block naming.

A text is cut into blocks of a fixed number of characters. The distinct blocks are sorted and get integer names;
then adjacent names are paired and the distinct pairs are sorted and named, level by level, until one name is left
for the document. Two documents have the same (level, name) exactly when their texts are the same.

Blocks travel under a 64-bit digest, so each text is shuffled once, after equal blocks have been merged. Digests
that two different blocks share are found by counting and told apart by the blocks themselves, so no collision
reaches the result. All else moves as integers. Every level is a written table.

Edge cases: a null text counts as empty; all empty texts are equal. A row with a null id is a document like any
other and only stays if its whole group has null ids. Rows that repeat id and text are members of their group; one
row stays. An empty table gives an empty result. Only the id and the text column are read; others may have any name.
Texts that are no valid UTF-8 are compared by their bytes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.scratch import Scratch, skew_aware

BLOCK_CHARS = 2048
NO_PARTNER = -1


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_chars: int = BLOCK_CHARS,
    digest: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256, n_blocks.

    Of equal texts the row with the largest id stays. ``digest`` must return a long; any will do, a poor one costs time.
    """
    spark = docs.sparkSession
    skew_aware(spark)
    scratch = Scratch(spark, "block-naming")
    source = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    valid = F.is_valid_utf8("text")
    blocks = F.regexp_extract_all(
        F.when(valid, F.col("text")).otherwise(F.hex(F.col("text").cast("binary"))),
        F.lit(f"(?s).{{1,{int(block_chars)}}}"),
        F.lit(0),
    )
    # Row numbers are fixed by being written.
    occurrences = scratch.keep(
        source.select(
            F.monotonically_increasing_id().alias("row"),
            "id",
            valid.alias("valid"),
            F.sha2(F.col("text").cast("binary"), 256).alias("sha"),
            blocks.alias("blocks"),
        )
        .select("row", "id", "valid", "sha", F.size("blocks").alias("n"), F.posexplode_outer("blocks").alias("pos", "block"))
        .select(
            "row",
            F.when(F.coalesce("pos", F.lit(0)) == 0, F.col("id")).alias("id"),
            "valid",
            F.when(F.coalesce("pos", F.lit(0)) == 0, F.col("sha")).alias("sha"),
            F.greatest("n", F.lit(1)).alias("n"),
            F.coalesce("pos", F.lit(0)).alias("pos"),
            digest(F.coalesce("block", F.lit(""))).alias("a"),
        ),
        "occurrences",
    )
    text_blocks = source.select(F.explode_outer(blocks).alias("block")).select(F.coalesce("block", F.lit("")).alias("block"))
    distinct = text_blocks.groupBy(digest(F.col("block")).alias("a"), "block").agg(F.count(F.lit(1)).alias("copies"))
    shared = scratch.keep(distinct.groupBy("a").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1"), "shared")
    nodes = occurrences.select("row", "n", "pos", "a", F.lit(0).alias("b"))
    if not shared.isEmpty():
        nodes = _tell_apart(source, occurrences, shared, distinct, blocks, digest, scratch)

    roots = None
    level = 0
    while True:
        names = scratch.keep(_names(nodes), f"names{level}")
        named = scratch.keep(nodes.join(names, ["a", "b"]).select("row", "n", "pos", "name"), f"level{level}")
        done = named.where("n = 1").select("row", F.lit(level).alias("level"), "name")
        roots = done if roots is None else roots.unionByName(done)
        if (named.agg(F.max("n")).first()[0] or 1) == 1:
            break
        nodes = (
            named.where("n > 1")
            .groupBy("row", F.floor(F.col("pos") / 2).cast("int").alias("pos"))
            .agg(
                F.ceil(F.max("n") / 2).cast("int").alias("n"),
                F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"),
                F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(NO_PARTNER)).alias("b"),
            )
        )
        level += 1

    members = occurrences.where("pos = 0").select("row", "id", "valid", "sha", F.col("n").alias("n_blocks")).join(roots, "row")
    identity = ["level", "name", "valid"]
    # Written, so that the join has a shuffle of its own, which Spark can split where copies abound.
    groups = scratch.keep(
        members.groupBy(*identity).agg(F.max(F.struct("id", "row")).alias("keep"), F.count(F.lit(1)).alias("group_size")),
        "groups",
    )
    return members.join(groups, identity).select(
        F.col("id").alias(id_col),
        F.col("keep.id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"),
        F.col("sha").alias("text_sha256"),
        "n_blocks",
    )


def _names(nodes: DataFrame) -> DataFrame:
    """An integer name for every distinct pair (a, b) of the nodes.

    Names follow the order of the pairs within a partition; equal pairs are merged before they are shuffled.
    """
    return (
        nodes.select("a", "b")
        .distinct()
        .sortWithinPartitions("a", "b")
        .select("a", "b", F.monotonically_increasing_id().alias("name"))
    )


def _tell_apart(source, occurrences, shared, distinct, blocks, digest, scratch) -> DataFrame:
    """Nodes in which blocks that share a digest have different second numbers."""
    numbered = scratch.keep(
        distinct.join(shared.select("a"), "a").select(
            "a", "block", F.row_number().over(Window.partitionBy("a").orderBy("block")).alias("b")
        ),
        "numbered",
    )
    # The same scan gives the same row numbers only within one plan, so rows are found again by their digest.
    rows = scratch.keep(
        source.select(
            F.sha2(F.col("text").cast("binary"), 256).alias("sha"), F.posexplode_outer(blocks).alias("pos", "block")
        )
        .select("sha", F.coalesce("pos", F.lit(0)).alias("pos"), F.coalesce("block", F.lit("")).alias("block"))
        .withColumn("a", digest(F.col("block")))
        .join(shared.select("a"), "a", "left_semi")
        .join(numbered, ["a", "block"])
        .groupBy("sha", "pos")
        .agg(F.max("b").alias("b")),
        "numbers",
    )
    heads = occurrences.where("pos = 0").select("row", "sha")
    return (
        occurrences.select("row", "n", "pos", "a")
        .join(heads, "row")
        .join(rows, ["sha", "pos"], "left")
        .select("row", "n", "pos", "a", F.coalesce("b", F.lit(0)).alias("b"))
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns; see :func:`exact_groups`."""
    spark = docs.sparkSession
    groups = Scratch(spark, "exact-dedup").keep(exact_groups(docs, id_col, text_col, **options), "groups")
    return keep_rows(docs, groups, id_col, text_col)


def keep_rows(docs: DataFrame, decisions: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` whose (id, text_sha256) ``decisions`` keeps; of repeated rows one."""
    mark = "__"
    while any(c.startswith(mark) for c in docs.columns):
        mark += "_"
    identity, sha, rows, text = (f"{mark}{x}" for x in ("id", "sha", "rows", "text"))
    kept = (
        decisions.groupBy(F.col(id_col).alias(identity), F.col("text_sha256").alias(sha))
        .agg(F.max("kept").alias(f"{mark}kept"), F.count(F.lit(1)).alias(rows))
        .where(f"{mark}kept")
    )
    columns = docs.columns
    marked = docs.withColumn(text, F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256))
    same = F.col(id_col).eqNullSafe(F.col(identity)) & (F.col(text) == F.col(sha))
    if kept.where(F.col(rows) > 1).isEmpty():
        return marked.join(kept, same, "left_semi").select(*columns)
    single = marked.join(kept.where(F.col(rows) == 1), same, "left_semi")
    repeated = marked.join(kept.where(F.col(rows) > 1), same, "left_semi").dropDuplicates([id_col, text])
    return single.unionByName(repeated).select(*columns)
