"""Tables partitioned by day whose every change becomes visible at once.

A change writes its rows into a folder of its own, a pack, and is then published
by one row appended to the table's log. Readers take the log as it is when they
start: they see a change whole or not at all, and files they read stay where they are
until `remove_unused` is told that nobody needs them. One process at a time changes a
table; any number may read it meanwhile.

An append adds rows to its days. A replacement stands for everything that the log held
of its days up to its base version, so appends published while it was written stay.
"""

from __future__ import annotations

import uuid
from collections.abc import Collection, Iterable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Record:
    """A small table that grows by single files, and is folded into one file now and then.

    Files lie in epochs; readers take the newest one, and folding starts the next.
    """

    path: str
    schema: T.StructType

    def read(self, spark: SparkSession) -> DataFrame:
        """The rows of the newest epoch; `epoch` is the last column."""
        schema = T.StructType([*self.schema.fields, T.StructField("epoch", T.IntegerType())])
        try:
            rows = spark.read.schema(schema).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], schema)
        return rows.filter(F.col("epoch") == rows.agg(F.max("epoch").alias("newest")).scalar())

    def rows(self, spark: SparkSession) -> tuple[list[Row], int]:
        """The rows of the newest epoch, here, and its number: one small job."""
        schema = T.StructType([*self.schema.fields, T.StructField("epoch", T.IntegerType())])
        try:
            found = spark.read.schema(schema).parquet(self.path).collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return [], 0
        newest = max((r["epoch"] for r in found), default=0)
        return [r for r in found if r["epoch"] == newest], newest

    def append(self, rows: DataFrame, epoch: int = 0) -> None:
        """Add a few rows as one file: all of them appear at once."""
        one_file = rows.coalesce(1).withColumn("epoch", F.lit(epoch))
        one_file.write.mode("append").partitionBy("epoch").parquet(self.path)

    def newest_epoch(self, spark: SparkSession) -> int:
        return self.read(spark).agg(F.max("epoch")).first()[0] or 0

    def fold(self, rows: DataFrame, epoch: int) -> None:
        """These rows in one file stand for everything up to `epoch`."""
        self.append(rows, epoch + 1)

    def remove_old(self, spark: SparkSession) -> None:
        """Delete earlier epochs, once no reader needs them."""
        newest = self.newest_epoch(spark)
        for folder in subfolders(spark, self.path):
            name, _, value = folder.rpartition("/")[-1].partition("=")
            if name == "epoch" and int(value) < newest:
                delete(spark, folder)


LOG = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("base", T.LongType()),  # null: an append
        T.StructField("pack", T.StringType()),  # null: names only
        T.StructField("days", T.ArrayType(T.DateType())),
        T.StructField("rows", T.LongType()),
        T.StructField("names", T.ArrayType(T.StringType())),
    ]
)


@dataclass(frozen=True)
class Entry:
    version: int
    base: int | None
    pack: str | None
    days: tuple[date, ...]
    rows: int
    names: tuple[str, ...]
    epoch: int


@dataclass(frozen=True)
class Change:
    """Rows that were written but not published yet."""

    pack: str
    days: tuple[date, ...]
    rows: int


@dataclass(frozen=True)
class DatedTable:
    """A table below `path`, partitioned by `day`; its log lies beside it."""

    path: str
    day: str = "date_now"

    # What the log says

    @property
    def log(self) -> Record:
        return Record(f"{self.path}-log", LOG)

    def entries(self, spark: SparkSession) -> list[Entry]:
        """The log, in order: one row per change since it was last folded."""
        found = [
            Entry(r["version"], r["base"], r["pack"], tuple(r["days"]), r["rows"], tuple(r["names"]), r["epoch"])
            for r in self.log.rows(spark)[0]
        ]
        return sorted(found, key=lambda e: (e.version, e.pack or ""))

    @staticmethod
    def live(entries: Iterable[Entry]) -> dict[date, list[Entry]]:
        """The entries whose packs hold each day's rows."""
        found: dict[date, list[Entry]] = {}
        for entry in entries:
            if entry.pack is None:
                continue
            for day in entry.days:
                kept = found.get(day, [])
                if entry.base is not None:
                    kept = [e for e in kept if e.version > entry.base]
                found[day] = [*kept, entry]
        return found

    @staticmethod
    def names(entries: Iterable[Entry]) -> set[str]:
        return {name for entry in entries for name in entry.names}

    # Reading

    def folder(self, pack: str) -> str:
        return f"{self.path}/pack={pack}"

    def read(
        self,
        spark: SparkSession,
        schema: T.StructType,
        entries: list[Entry] | None = None,
        days: Collection[date] | None = None,
        only: Collection[str] | None = None,
    ) -> DataFrame:
        """The table's rows, of some `days` or of some packs (`only`) if asked for.

        Only the folders of wanted days and live packs are listed.
        """
        live = self.live(self.entries(spark) if entries is None else entries)
        paths = []
        for day in live if days is None else days:
            for entry in live.get(day, []):
                # An entry that empties a day has no folder.
                if (only is None or entry.pack in only) and entry.rows:
                    paths.append(f"{self.folder(entry.pack)}/{self.day}={day.isoformat()}")
        if not paths:
            return spark.createDataFrame([], schema)
        reader = spark.read.schema(schema).option("basePath", self.path)
        return reader.parquet(*sorted(set(paths))).select(*schema.names)

    # Changing

    def write(self, df: DataFrame, cluster: Sequence[str] = ()) -> Change:
        """Write a pack; its days are read back from its folder names and file footers.

        The rebalance hint gathers a day's rows, so a quiet day gets one file and a busy one several, by size.
        With ``cluster`` files hold ranges of these columns instead, sorted, and a Bloom filter on the first:
        readers that look for few of its values skip files, row groups and pages by their statistics. The ranges
        go by all of the columns, so a value that fills a third of a day is cut by the next column.
        """
        pack = uuid.uuid4().hex
        if cluster:
            ranged = df.repartitionByRange(self.day, *cluster).sortWithinPartitions(self.day, *cluster)
            writer = ranged.write.option(f"parquet.bloom.filter.enabled#{cluster[0]}", True)
        else:
            writer = df.hint("rebalance", self.day).write
        writer.partitionBy(self.day).parquet(self.folder(pack))
        written = df.sparkSession.read.schema(df.schema).parquet(self.folder(pack))
        counts = {r[0]: r[1] for r in written.groupBy(self.day).count().collect()}
        return Change(pack, tuple(sorted(counts)), sum(counts.values()))

    def publish(
        self,
        spark: SparkSession,
        entries: list[Entry],
        change: Change | None,
        names: Collection[str] = (),
        base: int | None = None,
        replaced: Collection[date] = (),
        appended: Change | None = None,
    ) -> Entry:
        """Make a change visible: one file appended to the log.

        With `base` the change replaces what the entries up to that version hold of its own days and of
        `replaced`; rows of an `appended` pack are added in the same step. `entries` is the log the
        writer started from.
        """
        last = entries[-1] if entries else Entry(0, None, None, (), 0, (), 0)
        pack, days, rows = (change.pack, change.days, change.rows) if change else (None, (), 0)
        # Days that the change empties: nothing of them is read any more.
        empty = tuple(sorted(set(replaced) - set(days)))
        emptied = [Entry(last.version + 1, base, "", empty, 0, (), last.epoch)] if empty else []
        entry = Entry(last.version + 1, base, pack, days, rows, tuple(sorted(names)), last.epoch)
        more = [] if appended is None else [
            Entry(last.version + 1, None, appended.pack, appended.days, appended.rows, (), last.epoch)]
        return self._append(spark, *more, *emptied, entry)

    def _append(self, spark: SparkSession, *entries: Entry) -> Entry:
        rows = [(e.version, e.base, e.pack, list(e.days), e.rows, list(e.names)) for e in entries]
        self.log.append(spark.createDataFrame(rows, LOG), entries[-1].epoch)
        return entries[-1]

    # Housekeeping

    def compact(
        self,
        spark: SparkSession,
        schema: T.StructType,
        closed_before: date,
        packs_of_a_day: int = 8,
        cluster: Sequence[str] = (),
    ) -> Entry | None:
        """Rewrite closed days that have `packs_of_a_day` packs or more into sized files, clustered if asked for.

        Readers keep what they see: the old packs stay, and the new one takes their place in one step. Afterwards
        a closed day has fewer packs than that, however many runs came.
        """
        entries = self.entries(spark)
        many = [d for d, of in self.live(entries).items() if d < closed_before and len(of) >= packs_of_a_day]
        if not many:
            return None
        change = self.write(self.read(spark, schema, entries, many), cluster)
        return self.publish(spark, entries, change, base=entries[-1].version, replaced=many)

    def fold_log(self, spark: SparkSession) -> None:
        """Rewrite the log as the live packs and all names, in one file of a new epoch."""
        entries = self.entries(spark)
        if len(entries) < 2:
            return
        days: dict[Entry, list[date]] = {}
        for day, of in self.live(entries).items():
            for entry in of:
                days.setdefault(entry, []).append(day)
        epoch, version = entries[-1].epoch + 1, entries[-1].version
        folded = [
            Entry(e.version, None, e.pack, tuple(sorted(own)), e.rows, (), epoch) for e, own in days.items() if e.rows
        ]
        everything = Entry(version, None, None, (), 0, tuple(sorted(self.names(entries))), epoch)
        self._append(spark, *folded, everything)

    def remove_unused(self, spark: SparkSession) -> list[str]:
        """Delete packs, and days of packs, that the log no longer needs, and log epochs before the last.

        Returns the packs that are gone. To be called when no reader is left that started before the last change.
        """
        needed: dict[str, set[str]] = {}
        for day, of in self.live(self.entries(spark)).items():
            for entry in of:
                needed.setdefault(entry.pack, set()).add(day.isoformat())
        removed = []
        for folder in subfolders(spark, self.path):
            name, _, pack = folder.rpartition("/")[-1].partition("=")
            if name == "pack" and pack not in needed:
                delete(spark, folder)
                removed.append(pack)
            elif name == "pack":
                for part in subfolders(spark, folder):
                    name, _, day = part.rpartition("/")[-1].partition("=")
                    if name == self.day and day not in needed[pack]:
                        delete(spark, part)
        self.log.remove_old(spark)
        return removed


# Spark itself neither lists nor deletes folders, so Hadoop's file system is asked, here and nowhere else.


def _files(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern."""
    files, hadoop = _files(spark, pattern)
    return [str(s.getPath().toString()) for s in files.globStatus(hadoop) or []]


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Folders directly below a path; none if it does not exist."""
    files, hadoop = _files(spark, path)
    if not files.exists(hadoop):
        return []
    return [str(s.getPath().toString()) for s in files.listStatus(hadoop) if s.isDirectory()]


def delete(spark: SparkSession, path: str) -> None:
    files, hadoop = _files(spark, path)
    files.delete(hadoop, True)


def move_new(spark: SparkSession, path: str, to: str) -> None:
    """Rename a file to a name that does not exist yet, making the folder above it."""
    files, hadoop = _files(spark, path)
    _, target = _files(spark, to)
    if files.exists(target):
        raise FileExistsError(to)
    files.mkdirs(target.getParent())
    if not files.rename(hadoop, target):
        raise OSError(f"cannot rename {path} to {to}")
