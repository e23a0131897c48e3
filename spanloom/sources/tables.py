"""The hot tables: Parquet by day and write, idempotent writes, retention, compaction.

Layout: ``<root>/<table>/dt=<day>/write_id=<id>``. Writing the same ``write_id``
again replaces its partitions, so a replayed batch changes nothing. Raw spans also have an
index from trace and request ids to files.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanloom.functions.scalars import instant
from spanloom.operators.heavy import merge_value_states
from spanloom.operators.rollup import HOUR, MINUTE, QUANTILE_STATES, SUM_STATES, merge_states
from spanloom.registry import Registry
from spanloom.schema import (
    ALLOWLIST,
    DEAD_LETTERS,
    DIMENSION_COLUMNS,
    HEALTH,
    OFFSETS,
    RETENTION,
    SPANS,
)
from spanloom.session import literal_rows
from spanloom.sources import files, lookup
from spanloom.sources.commits import CommitConflict, CommitLog

_SNAPSHOT = "snapshot-"
_COMPACTION = "dt date, write_id string, replaced array<string>, revoked boolean"


def _states_schema(time_column: str) -> T.StructType:
    doubles = {"itl_sum", "queue_time_sum", "kv_cache_sum"}
    fields = [T.StructField(time_column, T.TimestampType())]
    fields += [T.StructField(c, T.StringType()) for c in DIMENSION_COLUMNS]
    fields += [
        T.StructField(c, T.DoubleType() if c in doubles else T.LongType()) for c in SUM_STATES
    ]
    fields += [T.StructField(c, T.BinaryType()) for c in ("traces", *QUANTILE_STATES)]
    fields.append(T.StructField("kv_cache_max", T.DoubleType()))
    return T.StructType(fields)


# table -> (schema, time column, sort order inside a file)
TABLES: dict[str, tuple[T.StructType, str, tuple[str, ...]]] = {
    "spans_raw": (SPANS, "ts", ("tenant_id", "model", "ts")),
    "spans_1m": (_states_schema(MINUTE), MINUTE, (*DIMENSION_COLUMNS, MINUTE)),
    "spans_1h": (_states_schema(HOUR), HOUR, (*DIMENSION_COLUMNS, HOUR)),
    "values_1m": (
        T.StructType(
            [
                T.StructField(MINUTE, T.TimestampType()),
                T.StructField("dimension", T.StringType()),
                T.StructField("value", T.StringType()),
                T.StructField("spans", T.LongType()),
            ]
        ),
        MINUTE,
        ("dimension", "value", MINUTE),
    ),
    "offsets": (OFFSETS, "consumed_at", ("topic", "partition", "first_offset")),
    "dead_letters": (DEAD_LETTERS, "ingested_at", ("ingested_at", "topic", "partition")),
    "health": (HEALTH, "sampled_at", ("sampled_at",)),
}


def time_range(
    df: DataFrame, column: str, start: datetime | None, end: datetime | None
) -> DataFrame:
    """Half-open ``[start, end)`` on a time column, with the day predicate that prunes partitions."""
    if start is not None:
        df = df.filter((F.col(column) >= instant(start)) & (F.col("dt") >= F.lit(start.date())))
    if end is not None:
        df = df.filter((F.col(column) < instant(end)) & (F.col("dt") <= F.lit(end.date())))
    return df


class TableStore:
    """Hot tables under one root folder."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    # --- rows -----------------------------------------------------------------

    def write(self, df: DataFrame, table: str, write_id: str) -> None:
        """Write rows under an id, replacing what that id wrote to the same days before.

        Where a snapshot holds the earlier rows of that id, the snapshot is withdrawn
        once the new rows are there, and the writes it was made of count again. After
        ``vacuum`` has deleted those, the id cannot be written any more. Days the id wrote
        to before and no longer has rows for are emptied: a batch replayed after midnight
        arrives on another day.
        """
        schema, time_column, order = TABLES[table]
        base = self._log(table).version()
        withdrawn = self.snapshots_of(table, write_id)
        before = {
            folder: set(files.data_files(self.spark, folder))
            for folder in files.matching(self.spark, f"{self.path(table)}/dt=*/write_id={write_id}")
        }
        ready = df.select(
            *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema],
            F.to_date(time_column).alias("dt"),
            F.lit(write_id).alias("write_id"),
        )
        # Few, even files per day; a day with most of the rows is split.
        spread = ready.hint("rebalance", F.col("dt")).sortWithinPartitions("dt", *order)
        writer = (
            spread.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "zstd")
            .partitionBy("dt", "write_id")
        )
        if table == "spans_raw":
            # Sized by the ids a row group really has.
            writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
            for column in ("trace_id", "request_id"):
                writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        writer.parquet(self.path(table))
        for folder, held in before.items():
            if held and held == set(files.data_files(self.spark, folder)):
                files.delete(self.spark, folder)
        if table == "spans_raw":
            self._index(write_id)
        if withdrawn:
            rows = [(day, snapshot, None, True) for day, snapshot in withdrawn]
            self._log(table).commit(rows, base)

    def _index(self, write_id: str) -> None:
        """Index the ids of a write of raw spans, read from its files."""
        folders = files.matching(self.spark, f"{self.path('spans_raw')}/dt=*/write_id={write_id}")
        if folders:
            lookup.index_files(self._stored("spans_raw", folders), self._folder(), write_id, self.index_path)

    @staticmethod
    def _folder() -> Column:
        return F.concat(F.lit("dt="), F.col("dt").cast("string"), F.lit("/write_id="), F.col("write_id"))

    @property
    def index_path(self) -> str:
        return f"{self.root}/_index/spans_raw"

    def find_spans(
        self, column: str, values: Sequence[str], start: datetime | None = None, end: datetime | None = None
    ) -> tuple[DataFrame, DataFrame]:
        """Raw spans whose trace or request id is one of ``values``, and the files the index named for each."""
        named = lookup.find_files(self.spark, self.index_path, column, values, start, end)
        named = named.withColumn("write_id", F.substring_index("folder", "write_id=", -1))
        named = self._visible(named, "spans_raw").select("value", "folder", "file")
        found = named.select("folder", "file").distinct().limit(lookup.MOST_FILES + 1).collect()
        if len(found) > lookup.MOST_FILES:
            rows = self.read("spans_raw", start, end)
        else:
            paths = [f"{self.path('spans_raw')}/{r['folder']}/{r['file']}" for r in found]
            # A file that was replaced since leaves its entry behind.
            present = sorted(p for p in paths if files.exists(self.spark, p))
            rows = time_range(self._stored("spans_raw", present), "ts", start, end)
        return rows.filter(F.col(column).isin(sorted(set(values)))), named

    def snapshots_of(self, table: str, write_id: str) -> list[tuple[date, str]]:
        """Snapshots in force that hold rows of a write, directly or through other snapshots."""
        log = self._log(table).read()
        if log is None:
            return []
        # One row for each compaction of a day in which the id, or a snapshot of it, took part.
        days = log.filter(F.array_contains("replaced", write_id)).select("dt").distinct()
        entries = log.join(days, "dt", "left_semi").collect()
        revoked = {(e["dt"], e["write_id"]) for e in entries if e["revoked"]}
        live = [e for e in entries if not e["revoked"] and (e["dt"], e["write_id"]) not in revoked]
        found: list = []
        names = {write_id}
        while fresh := [e for e in live if e not in found and names & set(e["replaced"])]:
            found += fresh
            names |= {e["write_id"] for e in fresh}
        for e in found:
            folder = f"{self.path(table)}/dt={e['dt'].isoformat()}"
            gone = set(e["replaced"]) - {d.split("=", 1)[1] for d in files.list_dirs(self.spark, folder)}
            if gone:
                raise ValueError(
                    f"{write_id} of {table} is part of {e['write_id']} on {e['dt']}, whose sources "
                    "were vacuumed; it cannot be written again"
                )
        return [(e["dt"], e["write_id"]) for e in found]

    def read(
        self,
        table: str,
        start: datetime | None = None,
        end: datetime | None = None,
        as_of: datetime | None = None,
    ) -> DataFrame:
        """Rows of a table; with ``as_of`` those past their retention are left out.

        A range lists the folders of its own days only.
        """
        _, time_column, _ = TABLES[table]
        if as_of is not None:
            kept = as_of - RETENTION[table]
            start = kept if start is None else max(start, kept)
        base = self.path(table)
        if start is None and end is None:
            paths = [base] if files.exists(self.spark, base) else []
        else:
            paths = [f"{base}/{day}" for day in self._days(table, start, end)]
        df = self._stored(table, paths)
        return time_range(self._visible(df, table), time_column, start, end) if paths else df

    def _stored(self, table: str, paths: list[str]) -> DataFrame:
        """Rows of folders or files as they lie there, replaced or not."""
        stored = T.StructType(
            [*TABLES[table][0], T.StructField("dt", T.DateType()), T.StructField("write_id", T.StringType())]
        )
        if not paths:
            return self.spark.createDataFrame([], stored)
        return self.spark.read.schema(stored).option("basePath", self.path(table)).parquet(*paths)

    def _days(self, table: str, start: datetime | None, end: datetime | None) -> list[str]:
        """Folders of the days a range touches."""
        return [
            d
            for d in files.list_dirs(self.spark, self.path(table))
            if d.startswith("dt=")
            and (start is None or d[3:] >= start.date().isoformat())
            and (end is None or d[3:] <= end.date().isoformat())
        ]

    def writes(self, table: str) -> DataFrame:
        """``(dt, write_id)`` of the writes in force, from a listing of folders."""
        found = files.matching(self.spark, f"{self.path(table)}/dt=*/write_id=*")
        pairs = [f.rsplit("/", 2)[-2:] for f in found]
        rows = [(date.fromisoformat(day[3:]), write.removeprefix("write_id=")) for day, write in pairs]
        listed = self.spark.createDataFrame(rows, "dt date, write_id string")
        return self._visible(listed, table)

    def read_writes(self, table: str, writes: Sequence[tuple[date, str]]) -> DataFrame:
        """The rows of some writes of some days; no other folder is opened."""
        base = self.path(table)
        return self._stored(table, [f"{base}/dt={day.isoformat()}/write_id={name}" for day, name in writes])

    # --- compaction -----------------------------------------------------------

    def _log(self, table: str) -> CommitLog:
        return CommitLog(self.spark, f"{self.root}/_compactions/{table}", _COMPACTION)

    def _in_force(self, log: DataFrame) -> DataFrame:
        """Compactions that were not withdrawn."""
        revoked = F.coalesce("revoked", F.lit(False))
        withdrawn = log.filter(revoked).select("dt", "write_id").distinct()
        return log.filter(~revoked).join(withdrawn, ["dt", "write_id"], "left_anti")

    def _visible(self, df: DataFrame, table: str) -> DataFrame:
        """Leave out replaced writes and snapshots that were never published.

        The log names one snapshot per compacted day and its replaced writes; its
        size depends on the number of writes, not of rows.
        """
        log = self._log(table).read()
        if log is None:
            return df.filter(~F.col("write_id").startswith(_SNAPSHOT))
        log = self._in_force(log)
        published = log.select("dt", "write_id").distinct()
        replaced = log.select("dt", F.explode("replaced").alias("write_id")).distinct()
        marks = published.withColumn("state", F.lit(1)).unionByName(
            replaced.withColumn("state", F.lit(2))
        )
        state = marks.groupBy("dt", "write_id").agg(F.max("state").alias("__state"))
        is_snapshot = F.col("write_id").startswith(_SNAPSHOT)
        return (
            df.join(state, ["dt", "write_id"], "left")
            .filter(
                F.when(is_snapshot, F.coalesce(F.col("__state"), F.lit(0)) == 1).otherwise(
                    F.col("__state").isNull()
                )
            )
            .select(*df.columns)
        )

    def compact(self, table: str, day: date) -> str | None:
        """Merge all writes of a day into one snapshot; returns its id.

        The snapshot counts from the moment its log row is written, and the writes
        it replaces stop counting at that same moment. ``vacuum`` deletes them. Where
        another compaction has taken some of the same writes meanwhile, this one is undone
        and there is no id to return.
        """
        _, time_column, _ = TABLES[table]
        base = self._log(table).version()
        folder = f"{self.path(table)}/dt={day.isoformat()}"
        present = [d.split("=", 1)[1] for d in files.list_dirs(self.spark, folder)]
        midnight = datetime.combine(day, time.min)
        rows = self.read(table, midnight, midnight + timedelta(days=1))
        # One name per write of this day, known from the folder listing.
        live = sorted(r[0] for r in rows.select("write_id").distinct().collect())
        live = [w for w in live if w in present]
        if len(live) < 2:
            return None
        rows = rows.filter(F.col("write_id").isin(live))
        snapshot = f"{_SNAPSHOT}{uuid.uuid4().hex[:12]}"
        if table in ("spans_1m", "spans_1h"):
            rows = merge_states(rows, [time_column, *DIMENSION_COLUMNS])
        if table == "values_1m":
            rows = merge_value_states(rows, [time_column, "dimension"])
        self.write(rows, table, snapshot)

        def conflict(entered: DataFrame) -> str | None:
            same = (F.col("dt") == F.lit(day)) & (
                F.col("write_id").isin(live) | F.arrays_overlap("replaced", F.array(*map(F.lit, live)))
            )
            taken = entered.filter(same).select("write_id").first()
            return f"{taken['write_id']} holds some of these writes" if taken else None

        try:
            self._log(table).commit([(day, snapshot, live, False)], base, conflict)
        except CommitConflict:
            for gone in files.matching(self.spark, f"{self.path(table)}/dt=*/write_id={snapshot}"):
                files.delete(self.spark, gone)
            return None
        return snapshot

    def vacuum(self, table: str) -> int:
        """Delete writes a published snapshot has replaced; returns how many."""
        log = self._log(table).read()
        if log is None:
            return 0
        replaced = self._in_force(log).select("dt", F.explode("replaced").alias("w")).distinct()
        deleted = 0
        for row in replaced.toLocalIterator():
            deleted += files.delete(self.spark, f"{self.path(table)}/dt={row['dt']}/write_id={row['w']}")
        self._trim_index(table)
        return deleted

    def _trim_index(self, table: str) -> None:
        """Forget the writes of which no day is left."""
        if table == "spans_raw":
            left = files.matching(self.spark, f"{self.path(table)}/dt=*/write_id=*")
            lookup.trim(self.spark, self.index_path, {f.rsplit("write_id=", 1)[1] for f in left})

    # --- retention ------------------------------------------------------------

    def expire(
        self,
        table: str,
        as_of: datetime,
        ttl: timedelta | None = None,
        exported_until: datetime | None = None,
        force: bool = False,
    ) -> list[str]:
        """Delete the days that lie wholly past retention; returns their folders.

        The day in which retention ends stays on disk; ``read`` with ``as_of``
        filters its expired rows. Raw spans go no further than ``exported_until``,
        the lake's watermark: a stalled export keeps its days. ``force`` overrides it.
        """
        cutoff = (as_of - (ttl or RETENTION[table])).date()
        if table == "spans_raw" and not force:
            if exported_until is None:
                raise ValueError("expiring raw spans needs the lake's watermark, or force")
            cutoff = min(cutoff, exported_until.date())
        expired = [
            d
            for d in files.list_dirs(self.spark, self.path(table))
            if d.startswith("dt=") and date.fromisoformat(d[3:]) < cutoff
        ]
        for d in expired:
            files.delete(self.spark, f"{self.path(table)}/{d}")
        self._trim_index(table)
        return expired

    # --- allowlist ------------------------------------------------------------

    def publish_allowlist(self, allowlist: DataFrame, registry: Registry) -> int:
        """Write the next allowlist version after checking it against the budgets."""
        registry.validate_columns(f.name for f in TABLES["spans_1m"][0])
        version = (self.allowlist_versions() or [0])[-1] + 1
        folder = f"{self.root}/allowlist/version={version}"
        unique = allowlist.groupBy("dimension", "value").agg(
            F.max("updated_at").alias("updated_at")
        )
        unique.coalesce(1).write.mode("overwrite").parquet(folder)
        budgets = {d.name: d.budget for d in registry.dimensions}
        counts = self.spark.read.parquet(folder).groupBy("dimension").count().collect()
        over = [r["dimension"] for r in counts if r["count"] > budgets.get(r["dimension"], 0)]
        if over:
            files.delete(self.spark, folder)
            raise ValueError(f"allowlist exceeds its budget for {sorted(over)}")
        return version

    def allowlist_versions(self) -> list[int]:
        """Published versions, oldest first. A version counts once its write has finished."""
        base = f"{self.root}/allowlist"
        names = files.list_dirs(self.spark, base)
        return sorted(
            int(n.split("=", 1)[1])
            for n in names
            if files.exists(self.spark, f"{base}/{n}/_SUCCESS")
        )

    def read_allowlist(self, version: int | None = None) -> DataFrame:
        """The given version, else the newest; empty before the first."""
        if version is None:
            versions = self.allowlist_versions()
            if not versions:
                return self.spark.createDataFrame([], ALLOWLIST)
            version = versions[-1]
        return self.spark.read.schema(ALLOWLIST).parquet(f"{self.root}/allowlist/version={version}")

    # --- physical facts -------------------------------------------------------

    def active_files(self, table: str) -> DataFrame:
        """Files and bytes per day of a table, from a listing that opens no file."""
        if not files.exists(self.spark, self.path(table)):
            return literal_rows(self.spark, [(None, 0, 0)], "dt, files, bytes").limit(0)
        listing = files.listed(self.spark, self.path(table), [self.path(table)])
        located = listing.select(F.col("dt").cast("date").alias("dt"), F.col("write_id").cast("string").alias("write_id"), "length")
        return (
            self._visible(located, table)
            .groupBy("dt")
            .agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
        )
