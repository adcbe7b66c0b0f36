"""Tables of the lake as Parquet folders: ``<root>/<layer>/<name>``.

``FactTable`` is partitioned and can be very large: a merge touches only the
partitions it must.  ``PeriodTable`` holds aggregates, and an upsert touches the months it
must.  ``SmallTable`` is written anew as a numbered snapshot; the newest complete one is
current, so its readers never see half a write.  A table has one writer at a time.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection, Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cowrie.model import DATASETS, REPORT_COLUMNS
from cowrie.operators import merge
from cowrie.session import shared_folder
from cowrie.sources import files

NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # Spark's folder name for a NULL


class DuplicateMatch(ValueError):
    """Several source rows would update one target row."""


class WrongShape(ValueError):
    """Rows whose columns aren't those of the table they are for."""


class HalfWritten(RuntimeError):
    """A table that a job is changing, or has left half changed."""


def _many(staged: DataFrame) -> bool:
    """Whether a table as it was staged has more rows than keys may be broadcast: its files' footers say."""
    return staged.count() > merge.BROADCAST_KEYS


class Lake:
    """Where each table of the platform lies and how it is merged.

    Facts are cut by country and day, or as ``layout`` says for a dataset: a thin one by
    day alone, so that its folders hold more than a few rows.
    """

    def __init__(self, spark: SparkSession, root: str, layout: Mapping[str, Sequence[str]] | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.layout = dict(layout or {})

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def _facts(self, layer: str, name: str, update: bool) -> FactTable:
        dataset = DATASETS[name]
        folders = self.layout.get(name, dataset.partition_by)
        return FactTable(self.spark, self.path(layer, name), dataset.key, folders, update)

    def bronze(self, name: str) -> FactTable:
        return self._facts("bronze", name, update=False)

    def silver(self, name: str) -> FactTable:
        return self._facts("silver", name, update=True)

    def gold(self, name: str) -> PeriodTable:
        return PeriodTable(self.spark, self.path("gold", name))

    def load(self, layer: str, name: str) -> DataFrame:
        """A table as it is now."""
        return {"bronze": self.bronze, "silver": self.silver, "gold": self.gold}[layer](name).read()

    def report(self) -> FactTable:
        table = FactTable(
            self.spark, self.path("gold", "regulatory_report"), "report_date", ["report_date"]
        )
        table.create(REPORT_COLUMNS)
        return table

    def ingested_files(self) -> FactTable:
        ledger = FactTable(self.spark, self.path("bronze", "ingested_files"), "path", ["dataset"])
        ledger.create(
            "path string, length long, modified timestamp, dataset string, ingested_at timestamp"
        )
        return ledger


class FactTable:
    """A partitioned table merged by one key.

    A merge first stores its source in ``_incoming``, a first load its folders in
    ``_rewrite``.  Should the job die while the partitions are being changed, the next
    one finds the source there and merges it again, or the folders and moves what is
    left of them, which ends in the same table.  Until then the table can't be
    read: a job that took part of a merge would set its mark beyond the rest.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        key: str,
        partition_by: Sequence[str],
        update: bool = False,
    ):
        self.spark = spark
        self.path = path
        self.key = key
        self.partition_by = list(partition_by)
        self.update = update
        if update and not self.partition_by:
            raise ValueError("a table whose rows are replaced has to be partitioned")
        self._schema: StructType | None = None
        self._schema_path = f"{path}/_schema"
        self._incoming = f"{path}/_incoming"
        self._rewrite = f"{path}/_rewrite"

    # -- reading ---------------------------------------------------------------

    def exists(self) -> bool:
        return files.is_complete(self.spark, self._schema_path)

    def create(self, schema: StructType | str) -> None:
        """Fix the schema if the table is new, also where a creation was left half done."""
        if not self.exists():
            empty = self.spark.createDataFrame([], schema)
            empty.coalesce(1).write.mode("overwrite").options(**files.MARK_DONE).parquet(self._schema_path)

    def schema(self) -> StructType:
        if self._schema is None:  # written once, when the table is created
            self._schema = self.spark.read.parquet(self._schema_path).schema
        return self._schema

    def read(self) -> DataFrame:
        """The table; the stored schema saves inferring one from files and folders."""
        self._refuse_half_written()
        return self._read(self.path)

    def _read(self, path: str) -> DataFrame:
        return self.spark.read.schema(self.schema()).parquet(path).select(*self.schema().names)

    def _read_folders(self, folders: Sequence[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema())
        reader = self.spark.read.schema(self.schema()).option("basePath", self.path)
        return reader.parquet(*folders).select(*self.schema().names)

    def _refuse_half_written(self) -> None:
        for staged in (self._rewrite, self._incoming):
            if files.is_complete(self.spark, staged):
                raise HalfWritten(f"{self.path} is being merged; if no job is, recover() completes it")

    def read_days(
        self, column: str, first: dt.date | None = None, last: dt.date | None = None
    ) -> DataFrame:
        """The rows of a range of days, both ends included.

        Where the table is cut by days only the folders wanted are listed, not the
        tens of thousands of a long history.
        """
        self._refuse_half_written()
        rows = F.lit(True)
        if first is not None:
            rows = rows & (F.col(column) >= F.lit(first))
        if last is not None:
            rows = rows & (F.col(column) <= F.lit(last))
        if (first is None and last is None) or column not in self.partition_by:
            return self.read().filter(F.col(column).isNotNull() & rows)
        wanted = [
            folder
            for folder, day in self.folders(column)
            if (first is None or day >= first) and (last is None or day <= last)
        ]
        return self._read_folders(wanted)

    def folders(self, column: str) -> list[tuple[str, dt.date]]:
        """The folders of each date the table is cut by."""
        folders = [self.path]
        for name in self.partition_by[: self.partition_by.index(column) + 1]:
            folders = [
                f"{folder}/{child}"
                for folder in folders
                for child in files.children(self.spark, folder)
                if child.startswith(f"{name}=")
            ]
        dated = [(folder, folder.rpartition("=")[2]) for folder in folders]
        return [(folder, dt.date.fromisoformat(d)) for folder, d in dated if d != NO_VALUE]

    def days(self, column: str) -> list[dt.date]:
        """The dates present, ascending.

        Where the table is cut by them they are the names of its folders: a few
        listings, while a query would open the footer of every file.
        """
        if not self.exists():
            return []
        self._refuse_half_written()
        if column in self.partition_by:
            return sorted({day for _, day in self.folders(column)})
        found = self.read().select(column).filter(F.col(column).isNotNull()).distinct()
        return sorted(row[0] for row in found.collect())

    def latest(self, column: str) -> dt.date | None:
        return max(self.days(column), default=None)

    def read_on(self, column: str, days: Collection[dt.date]) -> DataFrame:
        """The rows of some days, of which the table is cut: no other folder is listed or read."""
        self._refuse_half_written()
        return self._read_folders([folder for folder, day in self.folders(column) if day in days])

    def day_marks(self, column: str) -> DataFrame:
        """``day, mark`` of each day the table is cut by; a mark changes with any file of the day.

        Files are listed, not read.  The listing has as many tasks as the session has
        pieces in a shuffle, not as many as the data would need.
        """
        self._refuse_half_written()
        if not self.exists():
            return self.spark.createDataFrame([], "day date, mark long")
        found = files.listed(self.spark, self.path)
        day = F.try_to_date(F.regexp_extract("path", rf"/{column}=(\d{{4}}-\d\d-\d\d)/", 1))
        mark = F.bit_xor(F.xxhash64("path", "length", "modificationTime"))
        return found.select(day.alias("day"), "*").filter("day IS NOT NULL").groupBy("day").agg(mark.alias("mark"))

    # -- writing ---------------------------------------------------------------

    def append(self, df: DataFrame) -> None:
        self.create(df.schema)
        self._write(self._fitting(df), "append")

    def replace_partitions(self, df: DataFrame) -> None:
        """Exchange the partitions that ``df`` has rows for, and no others."""
        self.create(df.schema)
        self._write(self._fitting(df), "overwrite")

    def merge(self, source: DataFrame) -> None:
        """Insert the rows with a new key; update the others, or leave them be."""
        self.recover()
        self.create(source.schema)
        if self.partition_by and self._holds_nothing():
            self._first_load(self._fitting(source))
            return
        staged = self._fitting(source).write.mode("overwrite").options(**files.MARK_DONE)
        staged.parquet(self._incoming)
        self._merge_incoming()

    def _fitting(self, df: DataFrame) -> DataFrame:
        """``df`` if it has the columns of the table, in any order, else an error: nothing is dropped or blanked."""
        own = {f.name: f.dataType.simpleString() for f in self.schema()}
        brought = {f.name: f.dataType.simpleString() for f in df.schema}
        if own != brought or len(df.columns) != len(brought):
            wrong = sorted(set(own.items()) ^ set(brought.items()))
            raise WrongShape(f"{self.path} has other columns or types than what is written: {wrong}")
        return df

    def recover(self) -> None:
        """Finish what a job that died has left half done."""
        if files.is_complete(self.spark, self._rewrite):
            self._put_rewritten()
        if files.is_complete(self.spark, self._incoming):
            self._merge_incoming()

    def _merge_incoming(self) -> None:
        source = self._read(self._incoming)
        try:
            self._update_and_insert(source) if self.update else self._insert(source)
        except DuplicateMatch:
            files.remove(self.spark, self._incoming)  # refused, not to be tried again
            raise
        files.remove(self.spark, self._incoming)

    def _holds_nothing(self) -> bool:
        """Whether no file of rows is there yet: a first load has no key to look for."""
        begins = tuple(f"{c}=" for c in self.partition_by[:1]) or ("part-",)
        return not any(name.startswith(begins) for name in files.children(self.spark, self.path))

    def _first_load(self, source: DataFrame) -> None:
        """All folders are complete before the first is moved into the table; no row is staged besides."""
        self._partitioned(source.select(*self.schema().names), "overwrite", self._rewrite)
        self._update_and_insert(source) if self.update else self._insert(source)

    def _insert(self, source: DataFrame) -> None:
        if files.is_complete(self.spark, self._rewrite):  # a first load, whose folders are there
            self._put_rewritten()
            return
        if self._holds_nothing():
            self._write(source, "append")
            return
        self._write(merge.rows_to_insert(self._read(self.path), source, [self.key], _many(source)), "append")

    def _update_and_insert(self, source: DataFrame) -> None:
        """Rewrite the folders that hold rows to be replaced, append to the others."""
        if files.is_complete(self.spark, self._rewrite):
            self._put_rewritten()
            return
        if self._holds_nothing():
            self._write(source, "append")
            return
        keys, folder, many = [self.key], "_folder", _many(source)
        stored = self.spark.read.schema(self.schema()).parquet(self.path)
        where = F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias(folder)
        held = merge.rows_to_update(stored.select(self.key, *self.partition_by, where), source, keys, many)
        places = held.select(*self.partition_by, folder).distinct().collect()
        if not places:
            self._write(source, "append")
            return
        repeated = merge.repeated_keys(source, keys)
        if not repeated.isEmpty() and not merge.matched(repeated, merge.sized(held, many), keys).isEmpty():
            raise DuplicateMatch(f"several source rows for one {self.key} of {self.path}")

        # paths come as URIs; undone once they are the folders' own names
        folders = sorted({unquote(place[folder]) for place in places})
        touched = self.spark.createDataFrame(
            [tuple(place[c] for c in self.partition_by) for place in places],
            StructType([self.schema()[c] for c in self.partition_by]),
        ).distinct()
        kept = merge.unmatched(self._read_folders(folders), merge.sized(source, many), keys)
        self._partitioned(kept.unionByName(self._within(source, touched)), "overwrite", self._rewrite)
        self._put_rewritten(folders)
        self._write(merge.unmatched(source, touched, self.partition_by, null_safe=True), "append")

    def _within(self, df: DataFrame, touched: DataFrame) -> DataFrame:
        return merge.matched(df, touched, self.partition_by, null_safe=True)

    def _put_rewritten(self, emptied: Sequence[str] = ()) -> None:
        """Move the rewritten folders into the table; ``emptied`` ones that weren't rewritten go.

        Each folder is exchanged by itself.  What a dead job has not moved is still
        there for the next one, and its source, merged again, empties what it left.
        """
        written = [self._rewrite]
        for _ in self.partition_by:
            written = [f"{w}/{c}" for w in written for c in files.children(self.spark, w) if "=" in c]
        for folder in written:
            files.exchange(self.spark, folder, self.path + folder.removeprefix(self._rewrite))
        done = {self.path + folder.removeprefix(self._rewrite) for folder in written}
        for folder in emptied:
            if not any(files.same(self.spark, folder, d) for d in done):
                files.remove(self.spark, folder)
        files.remove(self.spark, self._rewrite)

    def _write(self, df: DataFrame, mode: str) -> None:
        self._partitioned(df.select(*self.schema().names), mode, self.path)

    def _partitioned(self, df: DataFrame, mode: str, path: str) -> None:
        if self.partition_by:
            # one writing task per partition, except that AQE splits the oversized ones
            df = df.hint("rebalance", *self.partition_by)
        # Spark marks a folder as complete only where it replaces all of it
        replaced = "dynamic" if path == self.path else "static"
        output = df.write.mode(mode).options(partitionOverwriteMode=replaced, **files.MARK_DONE)
        (output.partitionBy(*self.partition_by) if self.partition_by else output).parquet(path)


class PeriodTable(FactTable):
    """An aggregate with a column ``period``, in a folder for each month.

    An upsert reads and writes the months its rows lie in; other folders' files stay.  What
    the months will hold is complete before the first of them is exchanged, so a job that
    dies is finished by ``recover``, which needs no keys.
    """

    MONTH = "month"

    def __init__(self, spark: SparkSession, path: str):
        super().__init__(spark, path, "period", [self.MONTH], update=True)

    def read(self) -> DataFrame:
        return super().read().drop(self.MONTH)

    def latest(self, column: str = "period") -> dt.date | None:
        """The last period: only the folder of its month is read."""
        months = self.days(self.MONTH)
        if not months:
            return None
        return self.read_on(self.MONTH, {months[-1]}).agg(F.max(column).alias("m")).collect()[0]["m"]

    def upsert(self, source: DataFrame, keys: Sequence[str], null_safe: bool = False) -> int:
        """Replace the rows with the source's keys, of which ``period`` is one, and add the others.

        Returns the source's number of rows.  Several source rows for one stored row are
        refused; new keys may repeat.
        """
        if "period" not in keys:
            raise ValueError("rows are looked for in the months of their periods")
        self.recover()
        staged = shared_folder(self.spark, "upsert")  # computed once, though it is looked at more often
        source.withColumn(self.MONTH, F.trunc("period", "month")).write.parquet(staged)
        source = self.spark.read.parquet(staged)
        self.create(source.schema)
        source = self._fitting(source).select(*self.schema().names)
        counted = {row[self.MONTH]: row["count"] for row in source.groupBy(self.MONTH).count().collect()}
        if None in counted:
            raise WrongShape(f"{self.path} has no place for rows without a period")
        stored = self.read_on(self.MONTH, set(counted))
        if not merge.matched(merge.repeated_keys(source, keys), stored, keys, null_safe).isEmpty():
            raise DuplicateMatch(f"several source rows for one row of {self.path}")
        if counted:
            self._partitioned(merge.upserted(stored, source, keys, null_safe), "overwrite", self._rewrite)
            self._put_rewritten()
        return sum(counted.values())


class SmallTable:
    """An aggregate kept as numbered snapshots ``v00000001``, ``v00000002``, …"""

    def __init__(self, spark: SparkSession, path: str, partition_by: Sequence[str] = ()):
        self.spark = spark
        self.path = path
        self.partition_by = list(partition_by)

    def _versions(self) -> list[int]:
        names = [n for n in files.children(self.spark, self.path) if n.startswith("v")]
        complete = [n for n in names if files.is_complete(self.spark, f"{self.path}/{n}")]
        return sorted(int(n[1:]) for n in complete)

    def _folder(self, version: int) -> str:
        return f"{self.path}/v{version:08d}"

    def exists(self) -> bool:
        return bool(self._versions())

    def read(self, columns: str | None = None) -> DataFrame:
        """The newest snapshot; an empty one cut into folders has no file to take ``columns`` from."""
        reader = self.spark.read.schema(columns) if columns else self.spark.read
        return reader.parquet(self._folder(self._versions()[-1]))

    def write(self, df: DataFrame) -> None:
        versions = self._versions()
        target = self._folder(versions[-1] + 1 if versions else 1)
        output = df.write.mode("overwrite").options(**files.MARK_DONE)
        (output.partitionBy(*self.partition_by) if self.partition_by else output).parquet(target)
        for version in versions[:-1]:
            files.remove(self.spark, self._folder(version))
