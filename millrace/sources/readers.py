"""Scans of the operational sources."""

from __future__ import annotations

import datetime as dt
import functools
import re
from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructField, StructType, VariantType

# How many names an error message lists.
SHOWN = 20
# Sampled keys per part; a part's size is then within about a tenth of what is wanted.
SAMPLED = 400


def jdbc_options(
    url: str,
    query: str,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
    fetch_rows: int = 10_000,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Reader options for one relational query, split over a numeric column when one is named.

    Without ``partition_column`` the whole query arrives over one connection in one task, so name one for
    any table of size. The bounds only place the splits; rows outside them still arrive.
    """
    options = {"url": url, "fetchsize": str(fetch_rows), **(extra or {})}
    if partition_column is None:
        return {**options, "query": query}
    if bounds is None:
        raise ValueError("a partitioned read needs the bounds of its column")
    # "query" cannot be combined with a partition column, a derived table can.
    return {
        **options,
        "dbtable": f"({query}) source_rows",
        "partitionColumn": partition_column,
        "lowerBound": str(bounds[0]),
        "upperBound": str(bounds[1]),
        "numPartitions": str(partitions),
    }


def extract_sql_data(spark: SparkSession, query: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """The result of any SQL query: over JDBC with ``options``, else over the session's own tables."""
    if options is None:
        return spark.sql(query)
    return spark.read.format("jdbc").options(**options).load()


def hash_predicates(bucket_expression: str, parts: int) -> list[str]:
    """One condition per reading task, for tables without an evenly spread number to split by.

    ``bucket_expression`` is SQL of the source that gives a number for every row from its unique key, say
    ``hashtext(cast(id as text))``. Its sign does not matter: the remainder of a negative number is negative in
    SQL, so its absolute value counts. A row for which it is null would be lost, so those go to the first task.
    """
    bucket = f"abs(mod({bucket_expression}, {parts}))"
    return [f"({bucket} = 0 or ({bucket_expression}) is null)", *[f"{bucket} = {i}" for i in range(1, parts)]]


@dataclass(frozen=True)
class Split:
    """How a source table is dealt to reading tasks: by ranges of ``column``, which need not be unique or evenly spread.

    ``bucket`` is SQL of the source that gives a number from a hash of the unique key (see :func:`hash_predicates`); it divides the rows of a
    value that owns a part or more by itself. Without it such a value stays in one task.
    """

    column: str
    parts: int
    bucket: str | None = None


def _literal(value: object) -> str:
    if isinstance(value, (dt.datetime, dt.date)):
        return f"{'TIMESTAMP' if isinstance(value, dt.datetime) else 'DATE'} '{value.isoformat(*[' '] if isinstance(value, dt.datetime) else [])}'"
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)


def key_sample(keys: DataFrame, column: str, split: Split, seed: int = 1) -> list:
    """Sorted values of a bounded random sample of the key column, nulls left out: SAMPLED per part."""
    known = keys.select(F.col(column).alias("key")).where("key IS NOT NULL")
    return sorted(r["key"] for r in known.orderBy(F.rand(seed)).limit(SAMPLED * split.parts).collect())


def split_predicates(split: Split, sample: Sequence) -> list[str]:
    """Conditions that give every row once, in parts of about the same size, from a sorted sample of the key.

    Values that own a part or more are taken out and divided by ``bucket``; the others are cut at equal depths of the sample.
    Nulls go with the first part. An empty sample gives one condition that holds for all rows.
    """
    if not sample:
        return ["1 = 1"]
    size = len(sample) / split.parts
    counts = Counter(sample)
    heavy = sorted(v for v, n in counts.items() if n >= size)
    rest = [v for v in sample if v not in set(heavy)]
    out = []
    n_ranges = round(len(rest) / size) or 1
    # Upper ends of the ranges; the last has none.
    ends = sorted({rest[k * len(rest) // n_ranges] for k in range(1, n_ranges)}) if rest else []
    column = split.column
    without = f" and {column} not in ({', '.join(map(_literal, heavy))})" if heavy else ""
    for low, high in zip([None, *ends], [*ends, None], strict=True):
        bounds = [f"{column} >= {_literal(low)}"] * (low is not None) + [f"{column} < {_literal(high)}"] * (high is not None)
        within = " and ".join(bounds) or "1 = 1"
        out.append(f"(({within}){without})" + (f" or {column} is null" if low is None else ""))
    for value in heavy:
        pieces = round(counts[value] / size) if split.bucket else 1
        each = hash_predicates(split.bucket, pieces) if pieces > 1 else ["1 = 1"]
        out += [f"{column} = {_literal(value)} and ({e})" for e in each]
    return out


def extract_sql_split(
    spark: SparkSession, query: str, split: Split, url: str | None = None, properties: Mapping[str, str] | None = None
) -> DataFrame:
    """The result of a query, dealt out by ``split``: over JDBC with ``url``, one task per part, else over the session's own tables.

    The key column is read first, for a sample that places the cuts; where the sample lies only bears on the balance.
    """
    keys = f"SELECT {split.column} FROM ({query}) source_rows"
    reads = extract_sql_data(spark, keys) if url is None else extract_sql_data(spark, keys, {"url": url, **(properties or {})})
    predicates = split_predicates(split, key_sample(reads, reads.columns[0], split))
    if url is not None:
        return extract_sql_parts(spark, url, query, predicates, properties or {})
    parts = [spark.sql(f"SELECT * FROM ({query}) source_rows WHERE {p}") for p in predicates]
    return functools.reduce(DataFrame.unionAll, parts)


def extract_sql_parts(
    spark: SparkSession, url: str, query: str, predicates: Sequence[str], properties: Mapping[str, str]
) -> DataFrame:
    """The result of a query over JDBC, one task per condition."""
    return spark.read.jdbc(url, f"({query}) source_rows", predicates=list(predicates), properties=dict(properties))


class UndeclaredFields(Exception):
    """The documents hold fields that the declared schema does not name."""


def _documents(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    """One variant per document; a file may hold an array of them."""
    read = spark.read.option("multiLine", multi_line).option("mode", "FAILFAST").option("singleVariantColumn", "document").json(path)
    return read.selectExpr("explode(coalesce(try_variant_get(document, '$', 'array<variant>'), array(document))) AS document")


def undeclared_fields(
    spark: SparkSession, path: str, schema: StructType | str, multi_line: bool = False
) -> DataFrame:
    """Top-level fields of the documents that the schema does not declare, with the number of documents.

    One pass over the export; field names are counted in each task before they are shuffled.
    """
    declared = spark.createDataFrame([], schema).columns
    each = _documents(spark, path, multi_line)
    fields = each.select(F.explode(F.map_keys(F.expr("cast(document as map<string, variant>)"))).alias("field"))
    return fields.where(~F.col("field").isin(declared)).groupBy("field").agg(F.count(F.lit(1)).alias("documents"))


def document_schema(spark: SparkSession, path: str, multi_line: bool = False) -> StructType:
    """The fields of all documents at every depth, merged in one distributed aggregate.

    A field that is an object in one document and not in another, or has numbers and texts, is a variant.
    """
    tree = _documents(spark, path, multi_line).selectExpr("schema_of_variant_agg(document) AS tree").first()["tree"]
    kind = spark.sql(f"SELECT CAST(NULL AS {re.sub(r'OBJECT<', 'STRUCT<', tree)}) AS document").schema["document"].dataType if tree and tree != "VOID" else None
    return kind if isinstance(kind, StructType) else StructType()


def surplus_paths(declared: DataType, found: DataType, at: str = "") -> list[str]:
    """Paths of fields in ``found`` that reading by ``declared`` would lose; ``[]`` stands for the items of an array, ``*`` for the values of a map."""
    if isinstance(declared, StructType) and isinstance(found, StructType):
        out = []
        for f in found:
            path = f"{at}.{f.name}" if at else f.name
            out += surplus_paths(declared[f.name].dataType, f.dataType, path) if f.name in declared.names else [path]
        return out
    if isinstance(declared, ArrayType) and isinstance(found, ArrayType):
        return surplus_paths(declared.elementType, found.elementType, f"{at}[]")
    if isinstance(declared, MapType) and isinstance(found, StructType):
        return sorted({p for f in found for p in surplus_paths(declared.valueType, f.dataType, f"{at}.*")})
    # Texts and variants take anything; elsewhere values of several kinds do not fit.
    nested = isinstance(declared, (StructType, ArrayType, MapType))
    return [at] if nested and isinstance(found, VariantType) else []


def with_surplus(declared: DataType, found: DataType) -> DataType:
    """``declared`` with the surplus of ``found`` as text: nested values as they stand in the export, the value itself otherwise."""
    if isinstance(declared, StructType) and isinstance(found, StructType):
        known = [StructField(f.name, with_surplus(f.dataType, found[f.name].dataType) if f.name in found.names else f.dataType) for f in declared]
        return StructType(known + [StructField(f.name, StringType()) for f in found if f.name not in declared.names])
    if isinstance(declared, ArrayType) and isinstance(found, ArrayType):
        return ArrayType(with_surplus(declared.elementType, found.elementType))
    if isinstance(declared, MapType) and isinstance(found, StructType):
        value = declared.valueType
        for f in found:
            value = with_surplus(value, f.dataType)
        return MapType(declared.keyType, value)
    return StringType() if surplus_paths(declared, found, "x") else declared


def extract_document_data(
    spark: SparkSession, path: str, schema: StructType | str, multi_line: bool = False, surplus: str = "fail"
) -> DataFrame:
    """A whole document collection from its JSON export. The schema is declared, never inferred.

    Spark drops fields that the schema does not name, at any depth, so the fields of the export are gathered first. With
    surplus ones the read fails, or with ``surplus="stage"`` carries them as text after the declared fields of their
    object; ``surplus="drop"`` leaves them out knowingly, and saves that pass.
    A line-delimited export is split over tasks; ``multi_line`` reads each file in one task.
    """
    if surplus not in ("fail", "drop", "stage"):
        raise ValueError(f"surplus fields can fail, be dropped or staged, not {surplus}")
    declared = spark.createDataFrame([], schema).schema
    if surplus != "drop":
        found = document_schema(spark, path, multi_line)
        paths = surplus_paths(declared, found)
        if paths and surplus == "fail":
            raise UndeclaredFields(f"{path} holds fields that its schema does not declare: {paths[:SHOWN]}")
        if paths:
            declared = with_surplus(declared, found)
    return spark.read.schema(declared).option("multiLine", multi_line).option("mode", "FAILFAST").json(path)


def extract_collection_data(
    spark: SparkSession, uri: str, database: str, collection: str, schema: StructType | str
) -> DataFrame:
    """A whole collection straight from a document store, split over tasks by the connector.

    Needs the public MongoDB connector for Spark on the class path, which this library does not bring along.
    """
    options = {"connection.uri": uri, "database": database, "collection": collection}
    return spark.read.format("mongodb").schema(schema).options(**options).load()
