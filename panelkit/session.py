"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "panelkit") -> SparkSession:
    """Local/test session. On a cluster, the cluster's own session is used as is."""
    master = master or os.environ.get("PANELKIT_MASTER", "local[8]")
    parts = shuffle_partitions or int(os.environ.get("PANELKIT_SHUFFLE_PARTITIONS", "8"))
    b = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("PANELKIT_DRIVER_MEMORY", "8g"))
    )
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only when it is unset (local tests) do we create one under /tmp.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...): "
                               "a machine-local folder does not survive the loss of an executor")
        import tempfile

        d = tempfile.mkdtemp(prefix="panelkit-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def cluster_conf(total_cores: int, input_bytes: int | None = None) -> dict[str, str]:
    """Settings for a large cluster, as a dict for ``SparkSession.builder.config``.

    Shuffle partitions start at 3 x cores (AQE coalesces small ones toward the
    advisory size and splits skewed ones); file splits stay at 128 MB, so a
    100 TB scan is about 800k tasks of bounded memory; post-binning stages are
    small and coalesce away.
    """
    parts = max(3 * total_cores, 200)
    if input_bytes:
        # the first shuffle carries map-side partial aggregates, far smaller
        # than the input: one partition per GiB of input is ample
        parts = max(parts, int(input_bytes // 1024 ** 3))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 ** 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(128 * 1024 ** 2),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    }
