"""The archive: every span once, however often it was delivered, fed write by write.

The lake keeps what was ingested, copies included, and its view without copies shuffles on
every read. Here copies are left out when rows come in, so a read is a plain scan.

Layout: ``<root>/spans/dt=<day>/window=<load>`` holds the rows, sorted as in the lake, and
``<root>/keys`` the span ids of each load as a table clustered by span id. Incoming rows are
dealt out into the same clusters and compared with the stored ids of their days where those
lie: the stored side is neither shuffled nor sorted again. Copies of a span carry the same
time, so the ids of other days need not be read.

What to take in comes from the hot table's own list of writes: those no load has read yet.
Late rows arrive in such a write like any others, so no range of the source is scanned to
find them. A compaction hands its rows over once more and they are recognised as known. A
load counts once the log names it; two syncs at once end with one of them undone.
"""

from __future__ import annotations

import hashlib
import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.operators.dedup import dedup_spans
from spanloom.sources import files
from spanloom.sources.commits import CommitConflict, CommitLog
from spanloom.sources.lake import (
    LakeMismatchError,
    checksums,
    checksums_agree,
    export_columns,
    read_folders,
    write_sorted,
)
from spanloom.sources.tables import TableStore, time_range

# Part of the layout: another number needs a new archive.
CLUSTERS = 64
ROWS_PER_FILE = 4_000_000
_LOADS = "load string, dt date, write_id string, read long, kept long"


class SpanArchive:
    """An archive under one root folder."""

    def __init__(self, spark: SparkSession, root: str, clusters: int = CLUSTERS) -> None:
        self.spark, self.root, self.clusters = spark, root.rstrip("/"), clusters
        self.log = CommitLog(spark, f"{self.root}/_loads", _LOADS)
        self.keys_table = f"archive_keys_{hashlib.md5(self.root.encode()).hexdigest()[:12]}"

    # --- taking in ------------------------------------------------------------

    def pending(self, store: TableStore) -> DataFrame:
        """``(dt, write_id)`` of the raw writes in force that no load has read."""
        log = self.log.read()
        writes = store.writes("spans_raw")
        return writes if log is None else writes.join(log.select("dt", "write_id"), ["dt", "write_id"], "left_anti")

    def sync(self, store: TableStore) -> str | None:
        """Take in the writes since the last sync; returns the load's name, None if there is nothing new.

        If another sync comes first, this one is undone and raises ``CommitConflict``.
        """
        base = self.log.version()
        # One row for each write of a day.
        writes = [(r["dt"], r["write_id"]) for r in self.pending(store).collect()]
        if not writes:
            return None
        load = f"load-{uuid.uuid4().hex[:12]}"
        rows = store.read_writes("spans_raw", writes)
        days = sorted({day for day, _ in writes})
        try:
            read, kept = self._append(rows, load, days)
            entries = [(load, *write, read, kept) for write in writes]
            self.log.commit(entries, base, lambda entered: "another sync has come first")
        except (CommitConflict, LakeMismatchError):
            for folder in files.matching(self.spark, f"{self.root}/*/dt=*/*={load}"):
                files.delete(self.spark, folder)
            raise
        return load

    def _append(self, rows: DataFrame, load: str, days: list) -> tuple[int, int]:
        fresh = self.unknown(rows, days).withColumn("window", F.lit(load))
        handed = write_sorted(fresh, f"{self.root}/spans", ROWS_PER_FILE)
        folders = self._folders(load)
        if folders:
            stored = read_folders(self.spark, f"{self.root}/spans", folders)
            back = stored.agg(*checksums()).first().asDict()
            if not checksums_agree(handed, back):
                raise LakeMismatchError(f"load {load}: {handed} were written, {back} can be read")
            # Ids of what was stored, read from there.
            ids = stored.select("span_id", "dt", F.col("window").alias("load"))
            dealt = ids.repartition(self.clusters, "span_id")
            dealt.write.mode("append").insertInto(self._keys_table())
            return rows.count(), back["rows"]
        return rows.count(), 0

    def unknown(self, rows: DataFrame, days: list) -> DataFrame:
        """The first copy of each span of ``rows`` that the archive lacks, as lake rows."""
        first = export_columns(dedup_spans(rows, ("ts", "ingested_at")))
        dealt = first.repartition(self.clusters, "span_id")
        known = self.keys().filter(F.col("dt").isin(days)).select("span_id")
        return dealt.join(known.hint("merge"), "span_id", "left_anti").select(*first.columns)

    def _folders(self, load: str) -> list[str]:
        found = files.matching(self.spark, f"{self.root}/spans/dt=*/window={load}")
        return sorted("/".join(f.rsplit("/", 2)[-2:]) for f in found)

    # --- reading --------------------------------------------------------------

    def _keys_table(self) -> str:
        """The table of stored ids, declared in this session's catalogue if it is not yet."""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.keys_table} (span_id STRING, dt DATE, load STRING) USING parquet "
            f"PARTITIONED BY (dt, load) CLUSTERED BY (span_id) SORTED BY (span_id) INTO {self.clusters} BUCKETS "
            f"LOCATION '{self.root}/keys'"
        )
        if self.spark.conf.get("spark.sql.catalogImplementation") == "hive":
            self.spark.sql(f"ALTER TABLE {self.keys_table} RECOVER PARTITIONS")
        self.spark.catalog.refreshTable(self.keys_table)
        return self.keys_table

    def _unfinished(self, folder: str, name: str) -> list[str]:
        """Loads that lie in a folder but that the log does not name: being written, or given up."""
        present = {f.rsplit("=", 1)[1] for f in files.matching(self.spark, f"{self.root}/{folder}/dt=*/{name}=*")}
        log = self.log.read()
        # One row for each sync.
        done = set() if log is None else {r[0] for r in log.select("load").distinct().collect()}
        return sorted(present - done)

    def keys(self) -> DataFrame:
        """``(span_id, dt, load)`` of all spans in the archive."""
        table = self.spark.table(self._keys_table())
        return table.filter(~F.col("load").isin(self._unfinished("keys", "load")))

    def read(self, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
        """All spans, or those of ``[start, end)``: each once."""
        unfinished = self._unfinished("spans", "window")
        stored = read_folders(self.spark, f"{self.root}/spans", [""]).filter(~F.col("window").isin(unfinished))
        return time_range(stored, "ts", start, end).drop("window")

    def loads(self) -> DataFrame:
        """A row for each load: its place in the log, the writes and rows it read, the rows it kept."""
        log = self.log.read()
        if log is None:
            return self.spark.createDataFrame([], "sequence long, load string, writes long, read long, kept long")
        return log.groupBy("sequence", "load").agg(
            F.count("*").alias("writes"), F.max("read").alias("read"), F.max("kept").alias("kept")
        )
