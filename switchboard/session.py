"""Session construction and shared-storage helpers.

The library never depends on the caller's session time zone: every
timestamp it produces is TIMESTAMP_NTZ holding UTC wall-clock time.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the library relies on when it builds its own session (tests,
# bench). On a cluster the operator's session is used as is.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # checkpoint files are removed once their DataFrame is no longer referenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # the only automatic broadcasts: sides under 10 MB by plan estimate, or
    # under 10 MB of measured shuffle output when AQE re-plans a join
    "spark.sql.autoBroadcastJoinThreshold": str(10 << 20),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(10 << 20),
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "switchboard", extra: dict | None = None) -> SparkSession:
    master = master or os.environ.get("SPARK_MASTER", "local[8]")
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    if "spark.checkpoint.dir" not in conf and not _conf_from_env("spark.checkpoint.dir"):
        # local runs only: a cluster names its shared folder itself
        conf["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="switchboard-ckpt-")
        conf.setdefault("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="switchboard-wh-"))
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the operator sets it to shared storage and it is used as
    is. Only when it is unset (local tests) a scratch folder is created.
    """
    sc = spark.sparkContext
    current = sc.getConf().get("spark.checkpoint.dir", None)
    have = sc._jsc.sc().getCheckpointDir()
    if not have.isEmpty():
        return have.get()
    if not current:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="switchboard-ckpt-")
    sc.setCheckpointDir(current)
    return sc._jsc.sc().getCheckpointDir().get()


def _conf_from_env(key: str) -> str | None:
    args = os.environ.get("PYSPARK_SUBMIT_ARGS", "")
    return key if key in args else None


def checkpoint_dir(spark: SparkSession) -> str:
    return ensure_checkpoint_dir(spark)


MAX_SHUFFLE_PARTITIONS = 100_000


def recommended_conf(input_bytes: int, cores: int, input_bytes_per_partition: int = 1 << 30) -> dict:
    """Settings for a cluster run over ``input_bytes`` of input on ``cores`` cores.

    Shuffled bytes are a fraction of the input once columns are pruned and
    aggregates are partial, so shuffles start with one partition per ~1 GB
    of input (at least 2 per core, at most ``MAX_SHUFFLE_PARTITIONS`` to keep
    the map x reduce block count sane) and AQE coalesces them to the advisory
    size; scans split at 256 MB; skewed shuffle partitions (5x the median and
    over 512 MB) are split by AQE's skew join.
    """
    parts = min(MAX_SHUFFLE_PARTITIONS, max(2 * cores, -(-input_bytes // input_bytes_per_partition)))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
    }
