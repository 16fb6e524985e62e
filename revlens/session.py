"""Session construction and lineage helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on.  AQE re-plans joins at run time (a side under
# the broadcast threshold is broadcast, otherwise sort-merge), coalesces small
# shuffle partitions and splits skewed join partitions.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.scheduler.mode": "FAIR",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "revlens") -> SparkSession:
    """Build (or reuse) a session with the settings above.

    On a cluster ``master`` is left to spark-submit; tests pass ``local[*]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in BASE_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins.  Only when it is unset *and* the
    master is local (tests, single-machine runs) is a fresh scratch folder
    created; on a cluster a machine-local folder would not be shared, so an
    unset setting is an error there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a shared folder (e.g. on the cluster's "
                         "distributed file system) before running revlens jobs")
    local = tempfile.mkdtemp(prefix="revlens-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder.

    Used for intermediates that many later jobs reuse (the enriched fact, the
    scored table): a lost executor then re-reads the checkpoint instead of
    recomputing the whole join chain.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back.

    Unlike ``checkpoint()`` (serialized rows), later jobs get column pruning
    and filter pushdown on the materialized table, and a lost executor
    re-reads files instead of recomputing the lineage.
    """
    import uuid
    base = ensure_checkpoint_dir(df.sparkSession).rstrip("/")
    path = f"{base}/revlens-tables/{name}-{uuid.uuid4().hex[:12]}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def env_int(name: str, default: int) -> int:
    try:
        return int(os.environ.get(name, default))
    except ValueError:
        return default
