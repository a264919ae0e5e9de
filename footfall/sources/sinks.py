"""Write modes: full replace, append, sorted and clustered write, keyed upsert by commit record."""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.checks import duplicate_keys, null_rows
from ..session import cut


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Write `df` as the whole content of `path`."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy(*partition_by).parquet(path)


def append_rows(df: DataFrame, path: str, **part: str) -> None:
    """Adds rows to the table at `path`, those of one `part` (column=value) in a folder of their own.

    Writers of different parts share no temporary folder, so they can run at once.
    """
    folder = "/".join([path, *[f"{name}={value}" for name, value in part.items()]])
    df.write.mode("append").parquet(folder)


_CLAIMING = threading.Lock()


def claim(spark: SparkSession, path: str) -> bool:
    """Creates an empty file at `path`; False if it is there already. One of several callers at once gets True.

    The file system decides between drivers (creation without overwriting is atomic on HDFS), a lock inside this one.
    """
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    with _CLAIMING:
        try:
            return system.createNewFile(jvm_path)
        except Exception:
            if system.exists(jvm_path):  # another driver was faster
                return False
            raise


def write_sorted(df: DataFrame, path: str, month_of: str, order_by: Sequence[str]) -> None:
    """Full replace in monthly folders, each file sorted on `order_by`.

    Rows are spread by range over month and sort keys, so a large month takes
    several tasks and files, and no single task sorts the whole table.
    """
    # Ranges are found by a pass of their own; reading files, it does not compute the table twice.
    staged = cut(df.withColumn("month", F.date_format(month_of, "yyyy-MM")))
    ordered = staged.repartitionByRange("month", *order_by).sortWithinPartitions("month", *order_by)
    replace_table(ordered, path, ["month"])


def merge_by_key(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of `new`, plus those of `old` whose key is not in `new`."""
    kept = old.join(new.select(*keys).distinct(), list(keys), "left_anti")
    return kept.select(*new.columns).unionByName(new)


def write_clustered(df: DataFrame, name: str, path: str, keys: Sequence[str], order_by: Sequence[str], buckets: int) -> DataFrame:
    """Full replace of the table `name` in `buckets` buckets of `keys`, each sorted on the keys and `order_by`.

    Joins, aggregates and windows on the keys read it without moving its rows; a second table in as many buckets of the
    same keys joins without moving either.
    """
    spread = df.repartition(buckets, *keys)  # a bucket per task and file, whatever the session's partitions
    writer = spread.write.mode("overwrite").option("path", path).format("parquet")
    writer.bucketBy(buckets, *keys).sortBy(*keys, *order_by).saveAsTable(name)
    return df.sparkSession.table(name)


@dataclass(frozen=True)
class Commit:
    """A version of a table: its number, its schema and the folder (generation) of each part."""

    number: int
    schema: T.StructType
    parts: dict[str, str]


class VersionedTable:
    """A parquet table in parts by one column, such as days, that changes by one commit record at a time.

    A write puts whole new parts aside, in a folder of its own, and then adds a record that names the folder of every part.
    Readers follow the last record, so they see a write whole or not at all; a run that stops anywhere before its record
    has changed nothing, and running it again finishes the work. Folders that the two last records do not name go with the
    next write; `sweep` removes what broken runs left. A record has a line per part: a calendar's worth for days.
    """

    def __init__(self, spark: SparkSession, path: str, part: str):
        self.spark, self.path, self.part = spark, path.rstrip("/"), part
        self._base = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        self._system = self._base.getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, *names: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *names]))

    def _numbers(self) -> list[int]:
        folder = self._at("_commits")
        if not self._system.exists(folder):
            return []
        names = [status.getPath().getName() for status in self._system.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))

    def commit(self, number: int | None = None) -> Commit | None:
        """The last record, or the one of a number."""
        numbers = self._numbers()
        if not numbers or number is not None and number not in numbers:
            return None
        number = number or numbers[-1]
        stream = self._system.open(self._at("_commits", f"{number:09d}.json"))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        found = json.loads(text)
        return Commit(number, T.StructType.fromJson(found["schema"]), found["parts"])

    def latest(self) -> str | None:
        """The greatest part, from the record alone."""
        last = self.commit()
        return max(last.parts, default=None) if last else None

    def read(self, parts: Sequence[str] | None = None, generation: str | None = None) -> DataFrame | None:
        """The table, or the given parts of it; None before the first write. `generation` names a column for the folder."""
        last = self.commit()
        if last is None:
            return None
        folders = [
            f"{self.path}/_rows/generation={last.parts[p]}/{self.part}={p}" for p in sorted(last.parts if parts is None else parts) if p in last.parts
        ]
        if folders:
            found = self.spark.read.schema(last.schema).option("basePath", f"{self.path}/_rows").parquet(*folders)
            extra = [F.col("generation").cast("string").alias(generation)] if generation else []
            return found.select(*last.schema.names, *extra)
        empty = self.spark.createDataFrame([], last.schema)
        return empty.withColumn(generation, F.lit(None).cast("string")) if generation else empty

    def upsert(self, new: DataFrame, keys: Sequence[str]) -> None:
        """Merges `new` by its keys, which must be present and unique; only the parts it touches are read and rewritten."""
        new = cut(new)
        if not null_rows(new, keys).isEmpty() or not duplicate_keys(new, keys).isEmpty():
            raise ValueError(f"upsert keys {list(keys)} must be unique and not null")
        last = self.commit()
        touched = sorted(r[0] for r in new.select(F.col(self.part).cast("string")).distinct().collect())
        if last and not touched:
            return
        old = self.read([p for p in touched if p in last.parts]) if last else None
        merged = new if old is None else cut(merge_by_key(old, new, keys))
        generation = f"g{uuid.uuid4().hex}"
        if touched:
            # By range, a part's rows lie in few tasks, so its folder gets few files. Many parts need many tasks, however
            # little they hold, since each costs a file; few parts are sized by their rows.
            tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            spread = merged.repartitionByRange(*([tasks] if len(touched) >= tasks else []), self.part, *keys)
            spread.write.partitionBy(self.part).parquet(f"{self.path}/_rows/generation={generation}")
        parts = {**(last.parts if last else {}), **{p: generation for p in touched}}
        self._add(Commit((last.number if last else 0) + 1, new.schema, parts))
        self._forget()

    def _add(self, commit: Commit) -> None:
        """Makes the record visible in one step; fails if another write came first."""
        text = json.dumps({"schema": commit.schema.jsonValue(), "parts": commit.parts})
        aside, target = self._at("_commits", f".{uuid.uuid4().hex}"), self._at("_commits", f"{commit.number:09d}.json")
        stream = self._system.create(aside, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        with _CLAIMING:
            if self._system.exists(target) or not self._system.rename(aside, target):
                self._system.delete(aside, False)
                raise RuntimeError(f"{self.path} was changed by another run meanwhile; run again")

    def _forget(self) -> None:
        """Removes parts that only the third last record names, and records before it."""
        numbers = self._numbers()
        if len(numbers) < 3:
            return
        gone, *kept = [self.commit(n) for n in numbers[-3:]]
        held = {item for commit in kept for item in commit.parts.items()}
        for part, generation in gone.parts.items():
            if (part, generation) not in held:
                self._system.delete(self._at("_rows", f"generation={generation}", f"{self.part}={part}"), True)
        for number in numbers[:-2]:
            self._system.delete(self._at("_commits", f"{number:09d}.json"), False)

    def sweep(self, older_than_s: float = 86_400) -> int:
        """Removes folders older than this that no record names, as runs that broke off leave them; returns how many."""
        named = {g for n in self._numbers() for g in self.commit(n).parts.values()}
        removed, rows = 0, self._at("_rows")
        for status in self._system.listStatus(rows) if self._system.exists(rows) else []:
            generation = status.getPath().getName().removeprefix("generation=")
            if generation not in named and time.time() - status.getModificationTime() / 1000 >= older_than_s:
                removed += bool(self._system.delete(status.getPath(), True))
        return removed


def upsert(new: DataFrame, path: str, keys: Sequence[str], day: str) -> DataFrame:
    """Merges `new` into the table at `path`, which has a part per value of the date `day`; returns the table."""
    table = VersionedTable(new.sparkSession, path, day)
    table.upsert(new, keys)
    return table.read()


def between_days(df: DataFrame, day: str, first: date | None = None, last: date | None = None, month: str = "month") -> DataFrame:
    """Rows of days from `first` to `last`. A column `month` (yyyy-MM), as `write_sorted` stores it, is bounded too, so
    only the months' folders are read."""
    for bound, at_least in ((first, True), (last, False)):
        if bound is not None:
            for column, value in ((day, F.lit(bound)), *(((month, F.lit(f"{bound:%Y-%m}")),) if month in df.columns else ())):
                df = df.where(F.col(column) >= value if at_least else F.col(column) <= value)
    return df
