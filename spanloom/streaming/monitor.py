"""Health of a running stream, taken from its own progress events."""

from __future__ import annotations

import re
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from spanloom.functions.scalars import instant, utc_text
from spanloom.operators.health import consumer_lag, health_rows, parse_metrics
from spanloom.sources import files
from spanloom.sources.metrics import progress_offsets, read_metrics_dumps
from spanloom.sources.tables import TableStore


# How late a scrape or a progress event may come and still be recorded.
LATE_MARGIN = timedelta(hours=1)


class ProgressLog(StreamingQueryListener):
    """Keeps the progress events of all streams as small files in a shared folder.

    One file per event and query, so one per trigger, in a folder for each day. No
    event is ever overwritten; ``expire_progress`` deletes whole days.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        progress = event.progress
        # The same batch number comes again with every progress event of an idle stream.
        stamp = re.sub("[^0-9TZ]", "", progress.timestamp)
        day = progress.timestamp[:10]
        name = f"dt={day}/{progress.id}-{progress.batchId:012d}-{stamp}.json"
        line = " ".join(progress.json.splitlines())
        files.write_text(self.spark, f"{self.folder}/{name}", line + "\n")

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass


def lag_samples(spark: SparkSession, folder: str) -> DataFrame:
    """Lag per progress event: ``(sampled_at, total_lag, max_partition_lag, partitions)``."""
    events = spark.read.option("recursiveFileLookup", "true").text(folder)
    high, committed = progress_offsets(events)
    return consumer_lag(high, committed, by=("sampled_at",))


def per_minute(samples: DataFrame) -> DataFrame:
    """The newest sample of each minute, stamped with the minute."""
    rest = [c for c in samples.columns if c != "sampled_at"]
    return (
        samples.groupBy(F.date_trunc("minute", "sampled_at").alias("minute"))
        .agg(F.max_by(F.struct(*rest), "sampled_at").alias("r"))
        .select(F.col("minute").alias("sampled_at"), "r.*")
    )


def sampled_minutes(lag: DataFrame, metrics_lines: DataFrame) -> DataFrame:
    """Health rows of the minutes that have both a lag sample and a scrape.

    ``metrics_lines`` is ``(scrape, line)`` with the time of the scrape as text. A
    minute in which either side is missing gets no row: a gap is not a zero.
    """
    counters = parse_metrics(metrics_lines)
    counters = counters.select(
        F.col("scrape").try_cast("timestamp").alias("sampled_at"),
        *[c for c in counters.columns if c != "scrape"],
    ).filter(F.col("sampled_at").isNotNull())
    return health_rows(per_minute(lag), per_minute(counters))


def record_health(
    store: TableStore, lag: DataFrame, metrics_lines: DataFrame, write_id: str
) -> None:
    """Add the minutes of some samples to the health table."""
    store.write(sampled_minutes(lag, metrics_lines), "health", write_id)


def expire_progress(spark: SparkSession, folder: str, as_of: datetime, ttl: timedelta) -> list[str]:
    """Delete the days of progress events that lie wholly past ``ttl``."""
    cutoff = (as_of - ttl).date()
    gone = [
        d
        for d in files.list_dirs(spark, folder)
        if d.startswith("dt=") and date.fromisoformat(d[3:]) < cutoff
    ]
    for d in gone:
        files.delete(spark, f"{folder.rstrip('/')}/{d}")
    return gone


def health_pass(
    store: TableStore,
    lag: DataFrame,
    metrics_lines: DataFrame,
    until: datetime,
    margin: timedelta = LATE_MARGIN,
) -> tuple[datetime | None, datetime]:
    """Add the minutes before ``until`` that are complete and not recorded yet; returns the range looked at.

    It begins ``margin`` before the newest minute recorded, so that a scrape or progress
    event which comes late, after later minutes were recorded, still gets its row. The write
    is named by the range, and its own earlier rows do not count as recorded: a pass that
    failed half-way and runs again replaces them.
    """
    newest = store.read("health").agg(utc_text(F.max("sampled_at")).alias("t")).first()["t"]
    since = datetime.fromisoformat(newest) - margin if newest else None
    name = f"health-{since:%Y%m%dT%H%M%S}" if since else "health-first"
    write_id = f"{name}-{until:%Y%m%dT%H%M%S}"
    due = F.col("sampled_at") < instant(until)
    if since is not None:
        due = due & (F.date_trunc("minute", "sampled_at") >= instant(since))
    scraped = metrics_lines.withColumn("sampled_at", F.col("scrape").try_cast("timestamp"))
    complete = sampled_minutes(lag.filter(due), scraped.filter(due).drop("sampled_at"))
    recorded = store.read("health", since, until).filter(F.col("write_id") != write_id)
    fresh = complete.join(recorded.select("sampled_at").distinct(), "sampled_at", "left_anti")
    store.write(fresh, "health", write_id)
    return since, until


def start_health_job(
    store: TableStore, progress_folder: str, metrics_folder: str, checkpoint: str, every: str = "1 minute"
) -> StreamingQuery:
    """Sample health on a trigger: new progress events and new scrapes become health rows."""
    spark = store.spark

    def sample(_: DataFrame, __: int) -> None:
        now = datetime.now(UTC).replace(tzinfo=None, second=0, microsecond=0)
        lines = read_metrics_dumps(spark, metrics_folder).withColumn(
            # A dump is named by its time.
            "scrape", F.regexp_replace(F.regexp_replace("scrape", r"\.[a-z]+$", ""), "_", ":")
        )
        health_pass(store, lag_samples(spark, progress_folder), lines, now)

    ticks = spark.readStream.format("rate").option("rowsPerSecond", "1").load()
    return (
        ticks.writeStream.queryName("health_samples")
        .foreachBatch(sample)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=every)
        .start()
    )
