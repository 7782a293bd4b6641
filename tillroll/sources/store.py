"""Result tables: named, versioned folders or catalog tables."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tillroll.runtime import file_names, remove_path, small_text, write_once

_NAMES = "result_names"  # a small file for each version of a result, <name>.<number>: which folder holds it, and its schema


@dataclass(frozen=True)
class Snapshot:
    """The results that were current at one moment. Reading them asks the store no more."""

    store: ResultStore
    entries: Mapping[str, int]  # name to number of its version

    def names(self) -> list[str]:
        """Names of the results that have been written."""
        return sorted(self.entries)

    def read(self, name: str) -> DataFrame:
        """Read a result."""
        if name not in self.entries:
            raise KeyError(f"no result {name!r} in {self.store.root}")
        version, schema = self.store._entry(name, self.entries[name])
        return self.store._load(name, version, schema)


@dataclass(frozen=True)
class ResultStore:
    """Named results below one folder. ``format`` may be any data source the session has.

    Every write makes a new version beside the old one, in a folder of its own. A small file then names it, and only with that file it becomes
    current: a run that dies half-way leaves the last result as it was. The newest ``keep`` versions of a name stay,
    so that readers of the version before can end. Of two writers that replace the same version at a time, one fails.
    """

    spark: SparkSession
    root: str
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)
    keep: int = 2

    def path(self, name: str, version: str | None = None) -> str:
        return f"{self.root.rstrip('/')}/{name}" + (f"/{version}" if version else "")

    def _load(self, name: str, version: str, schema: T.StructType) -> DataFrame:
        reader = self.spark.read.format(self.format).schema(schema).options(**self.options)
        return reader.load(self.path(name, version))

    def write(
        self,
        df: DataFrame,
        name: str,
        partition_by: Sequence[str] = (),
        finish: Callable[[DataFrame], DataFrame] | None = None,
        sort_by: Sequence[str] = (),
        rows_per_file: int | None = None,
    ) -> DataFrame:
        """Replace a result and return it read back, so that later steps start from the files.

        A partitioned result is rebalanced on its partition columns first: files stay large, and a month
        with far more rows than the others is split over several tasks. A result with ``sort_by`` is dealt out in ranges of these columns and
        sorted, in files of ``rows_per_file`` rows at most, so that reads by them skip files and row groups by their statistics. ``finish``
        is applied to the frame as it is written, after rows have moved for the last time.
        """
        version = uuid.uuid4().hex
        if partition_by:
            df = df.hint("rebalance", *partition_by)
        elif sort_by:
            df = df.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by)
        if finish is not None:
            df = finish(df)
        writer = df.write.mode("errorifexists").format(self.format).options(**self.options)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if rows_per_file:
            writer = writer.option("maxRecordsPerFile", rows_per_file)
        try:
            writer.save(self.path(name, version))
        except BaseException:
            remove_path(self.spark, self.path(name, version))
            raise
        self._publish(name, version, df.schema)
        return self._load(name, version, df.schema)

    def _numbers(self) -> dict[str, list[int]]:
        """Numbers of the versions of every result, by one listing."""
        found: dict[str, list[int]] = {}
        for file in file_names(self.spark, self.path(_NAMES)):
            name, _, number = file.rpartition(".")
            if name and number.isdecimal():
                found.setdefault(unquote(name), []).append(int(number))
        return {name: sorted(numbers) for name, numbers in found.items()}

    def _entry_path(self, name: str, number: int) -> str:
        return f"{self.path(_NAMES)}/{quote(name, safe='')}.{number}"

    def _entry(self, name: str, number: int) -> tuple[str, T.StructType]:
        entry = json.loads(small_text(self.spark, self._entry_path(name, number)))
        return entry["version"], T.StructType.fromJson(entry["schema"])

    def _publish(self, name: str, version: str, schema: T.StructType) -> None:
        """Make a version the current one, and remove those that are older than the newest ``keep``."""
        older = self._numbers().get(name, [])
        entry = json.dumps({"version": version, "schema": schema.jsonValue()})
        write_once(self.spark, self._entry_path(name, older[-1] + 1 if older else 1), entry)
        for number in older[: max(0, len(older) + 1 - self.keep)]:
            folder, _ = self._entry(name, number)
            remove_path(self.spark, self._entry_path(name, number))
            remove_path(self.spark, self.path(name, folder))

    def snapshot(self) -> Snapshot:
        """The current version of every result."""
        return Snapshot(self, {name: numbers[-1] for name, numbers in self._numbers().items()})

    def read(self, name: str) -> DataFrame:
        """Read a result."""
        return self.snapshot().read(name)

    def names(self) -> list[str]:
        """Names of the results that have been written."""
        return self.snapshot().names()


def use_database(spark: SparkSession, name: str) -> None:
    """Create a database unless it exists, and make it current."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")
    spark.catalog.setCurrentDatabase(name)


ROWS_PER_BUCKET = 500_000


def bucket_count(rows: int, least: int = 8) -> int:
    """Buckets for a table of so many rows: a bucket is one task's work, so their number grows with the table and not their size."""
    return max(least, -(-rows // ROWS_PER_BUCKET))


def create_if_absent(
    spark: SparkSession,
    table: str,
    made: Callable[[], DataFrame],
    partition_by: Sequence[str] = (),
    buckets: int = 0,
    bucket_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
) -> DataFrame:
    """Create a table from a query unless the table exists (S5). ``made`` is not called if it does.

    With ``buckets`` the rows are dealt out by a hash of ``bucket_by`` and sorted: later grouping and joining by these columns moves
    no row. A value that holds a large share of all rows is then one task's work in each of these steps, so give columns
    without such a value.
    """
    if not spark.catalog.tableExists(table):
        df = made()
        if buckets:
            df = df.repartition(buckets, *bucket_by)  # a file a bucket, instead of one for each task and bucket
        elif partition_by:
            df = df.hint("rebalance", *partition_by)
        writer = df.write.mode("ignore").format("parquet")
        if buckets:
            writer = writer.bucketBy(buckets, *bucket_by).sortBy(*(sort_by or bucket_by))
        (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(table)
    return spark.table(table)


def table_names(spark: SparkSession) -> list[str]:
    """Tables and views of the current database."""
    return sorted(t.name for t in spark.catalog.listTables())


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Make a frame visible to SQL text under a name."""
    df.createOrReplaceTempView(name)
    return df


def preview(df: DataFrame, rows: int = 20) -> DataFrame:
    """A few rows for display."""
    return df.limit(rows)
