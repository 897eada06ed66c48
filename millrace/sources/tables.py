"""Parquet tables with a log of versions.

A table is a folder with a ``_log`` of manifests, one small JSON file per version that names the schema and the folders of its
rows. A version is written to folders that no manifest names yet and then committed by renaming its manifest into the log; the
rename fails if another writer has taken the number. So a reader has the old contents or the new, columns
included, at every moment, and whatever fails before the rename leaves the old version as it was. The last versions stay for
readers that are still at work; older manifests go, and with them the folders that only they name.

Each commit also points a catalogue view of the same name at the version, which is replaced in place.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from millrace.operators.runlog import new_tables

LOG = "_log"
KEPT_VERSIONS = 3
# Folders of a table that only grows, after which an append writes them as one.
MOST_FOLDERS = 100


class SchemaMismatch(Exception):
    """The new data does not fit the columns the table was created with."""


class Conflict(Exception):
    """Another writer has committed the version first."""


def target_schema(custom: str | None, default: str) -> str:
    """The schema a model asks for, else the default one."""
    return default if custom is None else custom


def columns_of(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in df.schema]


@dataclass(frozen=True)
class Version:
    """What a manifest says: the schema, and each folder with what is known of it, such as its batch or bucket."""

    number: int
    schema: StructType
    folders: Mapping[str, Mapping[str, Any]] = field(default_factory=dict)
    layout: Mapping[str, Any] = field(default_factory=dict)

    def text(self) -> str:
        return json.dumps({"columns": self.schema.jsonValue(), "folders": self.folders, "layout": self.layout})

    @staticmethod
    def of(number: int, text: str) -> Version:
        found = json.loads(text)
        return Version(number, StructType.fromJson(found["columns"]), found["folders"], found["layout"])


@dataclass(frozen=True)
class TableStore:
    """Tables under ``root``, a folder every executor can reach."""

    spark: SparkSession
    root: str
    keep: int = KEPT_VERSIONS
    publish: bool = True

    # Files ---------------------------------------------------------------------------------------

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, path: str):
        return self._path(path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def names(self, path: str) -> list[str]:
        """Names in a folder; none if it does not exist."""
        fs = self._fs(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(self._path(path))) if fs.exists(self._path(path)) else []

    def _read_text(self, path: str) -> str:
        stream = self._fs(path).open(self._path(path))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _write_text(self, path: str, text: str) -> None:
        stream = self._fs(path).create(self._path(path), True)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()

    def _rename(self, source: str, target: str) -> None:
        """Renames a file; fails if the target exists."""
        jvm = self.spark._jvm
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path(target).toUri(), self.spark._jsc.hadoopConfiguration())
        none = self.spark._sc._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            files.rename(self._path(source), self._path(target), none)
        except Exception as error:
            if "FileAlreadyExists" in str(error):
                raise Conflict(target) from error
            raise

    def remove(self, path: str) -> None:
        self._fs(path).delete(self._path(path), True)

    # Versions ------------------------------------------------------------------------------------

    def folder(self, schema: str, table: str) -> str:
        return f"{self.root}/{schema}/{table}"

    def _numbers(self, schema: str, table: str) -> list[int]:
        found = self.names(f"{self.folder(schema, table)}/{LOG}")
        return [int(n.removesuffix(".json")) for n in found if n.endswith(".json") and n[0].isdigit()]

    def _manifest(self, schema: str, table: str, number: int) -> str:
        return f"{self.folder(schema, table)}/{LOG}/{number:020d}.json"

    def version(self, schema: str, table: str) -> Version | None:
        """The last committed version."""
        numbers = self._numbers(schema, table)
        return Version.of(numbers[-1], self._read_text(self._manifest(schema, table, numbers[-1]))) if numbers else None

    def commit(self, schema: str, table: str, version: Version) -> None:
        """Makes ``version`` the current one; its number must be the one after the version that it was made from."""
        target = self._manifest(schema, table, version.number)
        draft = f"{self.folder(schema, table)}/{LOG}/.draft-{uuid.uuid4().hex}"
        self._write_text(draft, version.text())
        try:
            self._rename(draft, target)
        except Conflict:
            self.remove(draft)
            raise
        if self.publish:
            self._publish(schema, table, version)
        self._forget(schema, table)

    def _publish(self, schema: str, table: str, version: Version) -> None:
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{schema}` LOCATION '{self.root}/_schemas/{schema}'")
        names = ", ".join(f"`{n}`" for n in version.schema.names)
        parts = " UNION ALL ".join(f"SELECT {names} FROM parquet.`{p}`" for p in version.folders)
        if parts:
            self.spark.sql(f"CREATE OR REPLACE VIEW `{schema}`.`{table}` AS {parts}")

    def _forget(self, schema: str, table: str) -> None:
        """Removes the manifests before the last ``keep`` ones and the folders that no other manifest names."""
        numbers = self._numbers(schema, table)
        gone, kept = numbers[: -self.keep], numbers[-self.keep :]
        if not gone:
            return
        named = lambda n: set(Version.of(n, self._read_text(self._manifest(schema, table, n))).folders)
        alive = set().union(*map(named, kept))
        dead = set().union(*map(named, gone)) - alive
        for number in gone:
            self.remove(self._manifest(schema, table, number))
        for path in dead:
            # A folder that was only registered belongs to somebody else.
            if path.startswith(f"{self.folder(schema, table)}/"):
                self.remove(path)

    # Tables --------------------------------------------------------------------------------------

    def exists(self, schema: str, table: str) -> bool:
        return bool(self._numbers(schema, table))

    def rows_of(self, version: Version, folders: Sequence[str] | None = None) -> DataFrame:
        """The rows of a version, or of some of its folders."""
        paths = list(version.folders if folders is None else folders)
        return self.spark.read.schema(version.schema).parquet(*paths) if paths else self.spark.createDataFrame([], version.schema)

    def read(self, schema: str, table: str) -> DataFrame:
        version = self.version(schema, table)
        if version is None:
            raise LookupError(f"there is no table {schema}.{table}")
        return self.rows_of(version)

    def check_schema(self, schema: str, table: str, df: DataFrame) -> None:
        old, new = columns_of(self.read(schema, table)), columns_of(df)
        if sorted(old) != sorted(new):
            missing = sorted(set(old) - set(new))
            added = sorted(set(new) - set(old))
            raise SchemaMismatch(f"{schema}.{table}: missing {missing}, unexpected {added}")

    def fresh_folder(self, schema: str, table: str) -> str:
        return f"{self.folder(schema, table)}/v-{uuid.uuid4().hex}"

    def write_version(self, schema: str, table: str, df: DataFrame) -> str:
        """Writes the rows to a new folder that no manifest names yet."""
        path = self.fresh_folder(schema, table)
        df.write.parquet(path)
        return path

    def register(self, schema: str, table: str, path: str) -> None:
        """Makes an existing parquet folder readable as a table."""
        self.commit(schema, table, Version(1, self.spark.read.parquet(path).schema, {path: {}}))

    def sync(self, schema: str, listing: DataFrame, remote_schema: str | None = None) -> list[str]:
        """Registers the listed base tables that have no table yet, each a parquet folder.

        ``listing`` has ``table_schema``, ``table_name``, ``table_type`` and ``location``. Tables that exist are
        left alone, even if their columns changed. Only names of missing tables come to the driver, where table
        definitions are made anyway.
        """
        found = [n for n in self.names(f"{self.root}/{schema}") if self.exists(schema, n)]
        present = self.spark.createDataFrame([(n,) for n in found], "table_name string")
        added = []
        for row in new_tables(listing, present, remote_schema).toLocalIterator():
            self.register(schema, row["table_name"], row["location"])
            added.append(row["table_name"])
        return added

    def overwrite(self, schema: str, table: str, df: DataFrame, frozen: bool = False) -> DataFrame:
        """Replaces the contents. ``frozen`` keeps the columns of the first load and rejects others."""
        before = self.version(schema, table)
        if before is not None and frozen:
            self.check_schema(schema, table, df)
            df = df.select(*before.schema.names)
        path = self.write_version(schema, table, df)
        version = Version(before.number + 1 if before else 1, df.schema, {path: {}})
        self.commit(schema, table, version)
        return self.rows_of(version)

    def append(self, schema: str, table: str, df: DataFrame, batch: str | None = None) -> DataFrame:
        """Adds rows to a table that only grows, such as the run log.

        Rows of a named ``batch`` replace those that an earlier run of the same batch added, so a repeated run leaves the
        table as one run does.
        """
        before = self.version(schema, table)
        folders: dict[str, Mapping[str, Any]] = {}
        if before is not None:
            self.check_schema(schema, table, df)
            df = df.select(*before.schema.names)
            folders = {p: known for p, known in before.folders.items() if batch is None or known.get("batch") != batch}
            loose = [p for p, known in folders.items() if "batch" not in known]
            if len(loose) > MOST_FOLDERS:
                merged = self.write_version(schema, table, self.rows_of(before, loose))
                folders = {merged: {}} | {p: known for p, known in folders.items() if p not in loose}
        path = self.write_version(schema, table, df)
        folders[path] = {} if batch is None else {"batch": batch}
        version = Version(before.number + 1 if before else 1, before.schema if before else df.schema, folders)
        self.commit(schema, table, version)
        return self.rows_of(version)
