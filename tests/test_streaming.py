import os
import tempfile

from pyspark.sql import functions as F

from panelkit.operators.anomaly import score
from panelkit.schema import OBSERVATIONS, STATS
from panelkit.streaming.monitor import run_monitor


def test_stream_equals_batch(spark):
    base = tempfile.mkdtemp(prefix="panelkit-stream-", dir="/tmp")
    stats = spark.createDataFrame([("e", 0.0, 1.0, 0.0, 1.5, 1.5, 2.25), ("f", 10.0, 1.0, 9.0, 11.0, 2.0, 3.0)], STATS)
    stats.write.parquet(f"{base}/stats")
    obs = spark.createDataFrame([("e", None, 1.0), ("e", None, 5.0), ("f", None, 20.0), ("x", None, 1.0)], OBSERVATIONS)
    obs.write.parquet(f"{base}/in")
    src = spark.readStream.schema(OBSERVATIONS).parquet(f"{base}/in")
    run_monitor(spark, src, f"{base}/stats", f"{base}/log", f"{base}/ckpt")
    streamed = sorted(map(tuple, spark.read.parquet(f"{base}/log").orderBy("value").collect()))
    batch = sorted(map(tuple, score(obs, spark.read.parquet(f"{base}/stats")).orderBy("value").collect()))
    assert streamed == batch
    # restart from the checkpoint: nothing is scored twice
    run_monitor(spark, spark.readStream.schema(OBSERVATIONS).parquet(f"{base}/in"), f"{base}/stats",
                f"{base}/log", f"{base}/ckpt")
    assert spark.read.parquet(f"{base}/log").count() == 4
    # refresh mode re-reads the statistics every micro-batch
    run_monitor(spark, spark.readStream.schema(OBSERVATIONS).parquet(f"{base}/in"), f"{base}/stats",
                f"{base}/log2", f"{base}/ckpt2", refresh_stats=True)
    assert spark.read.parquet(f"{base}/log2").count() == 4
