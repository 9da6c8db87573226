"""Sinks: dated snapshots and the price track.

A price track is a folder partitioned by (account, date). A merge replaces only the partitions that its windows or
its new rows touch, by the engine's dynamic partition overwrite; what is to be written is always a table of its own
first, so a merge that fails before its last step has changed nothing, and one that fails in it is put right by
running it again. Partitions that a merge leaves without rows are dropped.

Readers of a track see each partition change as the engine commits it, as with any overwritten folder.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from floorwatch.operators.track import last_dates, observed_rows
from floorwatch.operators.windows import clear_windows
from floorwatch.sources.shared import file_system, materialise, read_small, write_small

PARTITIONS = ("account", "date")
SCHEMA_FILE = "_schema"
"""Columns and types of the folder, for readers without the table; an underscore hides it from scans."""


def arrange(df: DataFrame) -> DataFrame:
    """One file per partition where they are small, several where they are large."""
    inner = [c for c in ("location", "skuName") if c in df.columns]
    return df.hint("rebalance", *PARTITIONS).sortWithinPartitions(*PARTITIONS, *inner)


def save_snapshot(df: DataFrame, path: str, day: dt.date) -> str:
    """One retailer's final view, stamped with the day of the run.

    Written in parallel, in files of even size that are sorted by date, so that
    a reader can skip row groups without a folder per day.
    """
    stamped = f"{path}_{day:%y%m%d}"
    df.hint("rebalance").sortWithinPartitions("date").write.mode("overwrite").parquet(stamped)
    return stamped


def read_partitioned(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """A partitioned track; with a schema given, partition values keep their types."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def stored_partitions(spark: SparkSession, path: str) -> DataFrame:
    """Distinct (account, date, folder) of a track, from the listing; no file is opened."""
    fs, where = file_system(spark, path)
    if not any(s.isDirectory() for s in fs.listStatus(where)):
        return spark.createDataFrame([], "account string, date date, folder string")
    # Accounts are text even if all look like numbers: values are taken as they are written.
    setting = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    finally:
        spark.conf.set(setting, before)
    folder = F.regexp_extract("path", "account=[^/]*/date=[^/]*", 0).alias("folder")
    return listed.select(
        F.col("account").cast("string"), F.col("date").cast("date"), folder
    ).distinct()


def table_or_parquet(
    spark: SparkSession, table: str | None, path: str, schema: T.StructType | None = None
) -> DataFrame | None:
    """The table if it exists, else the folder, else None."""
    if table and spark.catalog.tableExists(table):
        return spark.table(table)
    fs, where = file_system(spark, path)
    return read_partitioned(spark, path, schema) if fs.exists(where) else None


def table_partitions(spark: SparkSession, table: str) -> DataFrame:
    """Distinct (account, date, folder) of a partitioned table, from the catalog's names."""
    names = spark.sql(f"SHOW PARTITIONS {table}").select(F.col("partition").alias("folder"))

    def value(name: str):
        text = F.regexp_extract("folder", f"(?:^|/){name}=([^/]*)", 1)
        plain = F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))
        return F.when(plain != "__HIVE_DEFAULT_PARTITION__", plain)

    return names.select(value("account").alias("account"), value("date").cast("date").alias("date"), "folder")


class TrackStore:
    """A folder holding one price track, and the table that shows it.

    A table of that name that lies elsewhere is used as it is: it is read, merged into and replaced, never re-created.
    """

    def __init__(self, spark: SparkSession, base: str, table: str | None = None):
        self.spark, self.base, self.table = spark, base.rstrip("/"), table

    def _stored_schema(self) -> T.StructType | None:
        text = read_small(self.spark, f"{self.base}/{SCHEMA_FILE}")
        return T.StructType.fromJson(json.loads(text)) if text else None

    def _elsewhere(self) -> bool:
        """Does the table exist without this folder being its own?"""
        known = self.table and self.spark.catalog.tableExists(self.table)
        return bool(known) and self._stored_schema() is None

    def read(self) -> DataFrame | None:
        """Table first, then the folder, else None."""
        if self.table and self.spark.catalog.tableExists(self.table):
            return self.spark.table(self.table)
        schema = self._stored_schema()
        return None if schema is None else read_partitioned(self.spark, self.base, schema)

    def partitions(self) -> DataFrame | None:
        """(account, date, folder) of what is stored, without opening a file; None if names do not tell."""
        if self._elsewhere():
            own = [c.name for c in self.spark.catalog.listColumns(self.table) if c.isPartition]
            return table_partitions(self.spark, self.table) if own == list(PARTITIONS) else None
        return None if self._stored_schema() is None else stored_partitions(self.spark, self.base)

    def last_dates(self) -> DataFrame | None:
        """(account, max_date) per lower-case account; None where there is no track yet."""
        names = self.partitions()
        if names is None:
            track = self.read()
            return None if track is None else last_dates(track)
        return last_dates(names)

    def save(
        self,
        df: DataFrame,
        mode: str,
        windows: DataFrame | None = None,
        distinct: bool = False,
        accounts: Sequence[str] = (),
    ) -> dict[str, int]:
        """``distinct`` says that ``df`` has no repeated rows, so none need removing.

        Returns how many rows came in, all and of the accounts given, counted on the way.
        """
        if mode == "overwrite":
            return self._replace(df, accounts)
        if mode == "append":
            if windows is None or windows.isEmpty():
                raise ValueError("append needs at least one window")
            return self.merge(df, windows, distinct, accounts)
        raise ValueError(f"Unknown save mode: {mode}")

    def replace(self, df: DataFrame) -> int:
        """Exactly the rows of ``df``; returns how many."""
        return self._replace(df)["rows"]

    def _replace(self, df: DataFrame, accounts: Sequence[str] = ()) -> dict[str, int]:
        counted, watch = observed_rows(df, f"rows of {self.base}", accounts)
        state = materialise(counted, "track")
        if self._elsewhere():
            state.select(self.spark.table(self.table).columns).write.mode("overwrite").insertInto(self.table)
        else:
            self._write(state, "static")
            self._publish(df.schema)
        return watch.get

    def merge(
        self, new: DataFrame, windows: DataFrame, distinct: bool = False, accounts: Sequence[str] = ()
    ) -> dict[str, int]:
        """Replace the windows by ``new``; partitions outside stay as they are, untouched."""
        existing = self.read()
        if existing is None:
            return self._replace(new if distinct else new.dropDuplicates(), accounts)
        elsewhere = self._elsewhere()
        if elsewhere and set(new.columns) != set(existing.columns):
            raise ValueError(f"{self.table} has other columns: {existing.columns}")
        schema = merged_schema(existing.schema if elsewhere else self._stored_schema(), new.schema)
        names = self.partitions()
        counted, watch = observed_rows(new if distinct else new.dropDuplicates(), f"new in {self.base}", accounts)
        incoming = materialise(counted, "incoming")
        if names is None:  # partitioned in another way: only as a whole
            state = clear_windows(existing, windows).unionByName(incoming).dropDuplicates()
            state = materialise(state.select(existing.columns), "track")
            state.write.mode("overwrite").insertInto(self.table)
            return watch.get
        touched = materialise(incoming.select(*PARTITIONS).distinct(), "touched")
        stored = materialise(names, "stored")
        outside = clear_windows(stored, windows)
        state = self._with_kept(existing, incoming, outside, touched)
        same = [stored[c].eqNullSafe(touched[c]) for c in PARTITIONS]
        gone = stored.join(outside.select("folder"), "folder", "left_anti").join(touched, same, "left_anti")
        # Names of emptied partitions: as many as the windows have days.
        emptied = [(r["account"], r["date"], r["folder"]) for r in gone.collect()]
        if elsewhere:
            setting = "spark.sql.sources.partitionOverwriteMode"
            before = self.spark.conf.get(setting)
            self.spark.conf.set(setting, "dynamic")
            try:
                state.select(existing.columns).write.mode("overwrite").insertInto(self.table)
            finally:
                self.spark.conf.set(setting, before)
        else:
            self._write(state, "dynamic")
        self._drop(emptied, elsewhere)
        if not elsewhere:
            self._publish(schema)
        return watch.get

    def _with_kept(
        self, existing: DataFrame, incoming: DataFrame, outside: DataFrame, touched: DataFrame
    ) -> DataFrame:
        """New state of the touched partitions: old rows matter only where new ones arrive outside every window.

        The old rows are joined with the partitions in question, so the scan prunes by them however many there are.
        """
        same = [outside[c].eqNullSafe(touched[c]) for c in PARTITIONS]
        both = materialise(outside.join(touched, same, "left_semi").select(*PARTITIONS), "both")
        if both.isEmpty():
            return incoming
        asked = both.filter(F.col("date") >= F.lit("0001-01-01").cast("date"))
        kept = existing.join(asked, list(PARTITIONS), "left_semi")
        unnamed = F.col("account").isNull() | F.col("date").isNull()
        if not both.filter(unnamed).isEmpty():
            kept = kept.unionByName(existing.filter(unnamed))
        state = kept.unionByName(incoming, allowMissingColumns=True).dropDuplicates()
        return materialise(state, "track")

    def _write(self, df: DataFrame, overwrite: str) -> None:
        writer = arrange(df).write.mode("overwrite").option("partitionOverwriteMode", overwrite)
        writer.partitionBy(*PARTITIONS).parquet(self.base)

    def _drop(self, emptied: list[tuple], elsewhere: bool) -> None:
        if not emptied:
            return
        if elsewhere:
            default = "__HIVE_DEFAULT_PARTITION__"
            specs = [
                "PARTITION (" + ", ".join(f"`{c}` = '{_quoted(str(v or default))}'" for c, v in zip(PARTITIONS, row)) + ")"
                for row in emptied
            ]
            self.spark.sql(f"ALTER TABLE {self.table} DROP IF EXISTS {', '.join(specs)}")
            return
        fs, _ = file_system(self.spark, self.base)
        path_of = self.spark._jvm.org.apache.hadoop.fs.Path
        for _, _, folder in emptied:
            fs.delete(path_of(f"{self.base}/{folder}"), True)

    def _publish(self, schema: T.StructType) -> None:
        """Note the columns, and bring the table's entry up to the folder."""
        write_small(self.spark, f"{self.base}/{SCHEMA_FILE}", schema.json())
        if self.table:
            known = self.spark.catalog.tableExists(self.table)
            if known and _kinds(self.spark.table(self.table).schema) != _kinds(schema):
                # The table is external: dropping its entry leaves the files alone.
                self.spark.sql(f"DROP TABLE {self.table}")
                known = False
            if not known:
                columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
                self.spark.sql(
                    f"CREATE TABLE {self.table} ({columns}) USING parquet "
                    f"PARTITIONED BY ({', '.join(PARTITIONS)}) LOCATION '{self.base}'"
                )
            self.spark.sql(f"MSCK REPAIR TABLE {self.table} SYNC PARTITIONS")
            self.spark.catalog.refreshTable(self.table)
        self.spark.catalog.refreshByPath(self.base)


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def _kinds(schema: T.StructType) -> set[tuple[str, str]]:
    return {(f.name, f.dataType.simpleString()) for f in schema.fields}


def merged_schema(old: T.StructType, new: T.StructType) -> T.StructType:
    """The old columns and then the new ones; a column may not change its type."""
    known = {f.name: f.dataType for f in old.fields}
    for field in new.fields:
        if known.get(field.name, field.dataType) != field.dataType:
            raise ValueError(
                f"{field.name} is {known[field.name].simpleString()} in the track, "
                f"not {field.dataType.simpleString()}"
            )
    added = [T.StructField(f.name, f.dataType, True) for f in new.fields if f.name not in known]
    return T.StructType([*old.fields, *added])
