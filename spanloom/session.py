"""Session settings and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that can be changed on a running session.
RUNTIME_CONF = {
    # Every timestamp in the data model is UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Groups with sketches a task holds before it sorts instead. A pair of empty
    # quantile sketches takes 32 KB, which no memory manager accounts for.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "512",
}


def build_session(
    app_name: str = "spanloom",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create a session with the settings the operators rely on."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        **RUNTIME_CONF,
        "spark.sql.parquet.compression.codec": "zstd",
        "spark.ui.showConsoleProgress": "false",
        # Call-site capture costs about a millisecond per column expression.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **(conf or {}),
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made elsewhere."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh directory for intermediate tables, in the folder all executors share.

    A cluster names that folder in ``spark.checkpoint.dir``. Only where it is
    unset (local tests) is a local temporary directory used.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def literal_rows(spark: SparkSession, rows: list[tuple], columns: str) -> DataFrame:
    """A few constant rows as a local relation, whose size the optimizer knows.

    ``createDataFrame`` hides its size behind an RDD, which rules out automatic
    broadcasts and constant folding.
    """

    def cell(value: object) -> str:
        if value is None:
            return "NULL"
        if isinstance(value, bool):
            return str(value)
        if isinstance(value, int):
            return f"{value}L"
        if isinstance(value, float):
            return f"{value!r}D"
        text = str(value).replace("\\", "\\\\").replace("'", "\\'")
        return f"'{text}'"

    body = ", ".join("(" + ", ".join(cell(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({columns})")
