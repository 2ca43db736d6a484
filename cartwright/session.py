"""Session settings and the shared folder that intermediate tables live in."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job relies on; safe to set on a running session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # At run time, when every partition of one side turned out this small, hash
    # it and leave the large side unsorted.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # Generated methods beyond 8,000 bytes are never compiled by the JVM: wide projections (validation, cleaning)
    # would be interpreted. Above this their expressions are split into methods that are.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app: str = "cartwright", master: str | None = None, **conf: str) -> SparkSession:
    """A session for scripts and tests; on a cluster spark-submit supplies the master."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own: there the driver
    and the executors are one process. On a cluster an unset folder is an error,
    because a machine-local path would not be seen by the other executors.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    own = tempfile.mkdtemp(prefix="cartwright-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def together(jobs: Iterable[Callable[[], object]]) -> list[object]:
    """Submit independent jobs side by side: one that leaves cores idle lets the next one start.

    With ``spark.scheduler.mode=FAIR`` they also share busy cores; by default the first goes first.
    """
    with ThreadPoolExecutor(max_workers=8) as pool:
        return [f.result() for f in [pool.submit(job) for job in jobs]]


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate result that several steps read, and read it back.

    Unlike a cache it outlives lost executors, and it cuts the lineage.
    """
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def held(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """The same for as long as a block runs: the files are removed at its end."""
    path = fresh_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    try:
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        jpath = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        jpath.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(jpath, True)


def release(spark: SparkSession) -> None:
    """Have Spark drop the shuffle files of finished steps.

    It does so when the driver collects garbage, which a large heap may never need to.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def fresh_dir(spark: SparkSession, label: str) -> str:
    """An unused path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"
