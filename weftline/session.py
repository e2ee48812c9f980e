"""Session helpers: a UTC session for local use, the runtime settings we rely on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the operators rely on. They can be changed on a running session, so no restart is needed.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even where that costs one more exchange further up.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Sessions of one key are merged in each task before the shuffle, so a hot key sends sessions and not rows.
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}

ROWS_PER_TASK = 1_000_000


def local_session(app: str = "weftline", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benches. On a cluster use the session you are given and call ``tune``."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def tune(spark: SparkSession) -> SparkSession:
    """Apply ``RUNTIME_SETTINGS`` to a session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A local session without the setting gets a temporary folder. A cluster session without it is refused, because a
    folder on one machine would be lost with that machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="weftline-")
        spark.conf.set("spark.checkpoint.dir", named)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/weftline/{purpose}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and read them back.

    The result survives lost executors, the plan above it stays short, and its size is known to the planner, which a
    later join needs to choose between broadcast and shuffle.
    """
    path = scratch_path(df.sparkSession, "step")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def task_count(rows: DataFrame) -> int:
    """Tasks for work on all these rows, each on ``ROWS_PER_TASK`` or so: more rows make more tasks, not larger ones."""
    return max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // ROWS_PER_TASK))
