"""A refresh that recomputes only the entities whose binned series changed.

    out/manifest/version=N   entity, digest, data_version   (one row per entity)
    out/<table>/version=N    the rows of the entities computed at refresh N

A refresh bins the new raw rows, takes one digest per entity and compares it with the
last manifest. The tables are built for the changed and new entities alone and written
under the new version; for the others the manifest goes on pointing at the version that
holds their rows, which is neither read nor written. The manifest is written last, by one
job: a refresh that dies before leaves the former state in force, and the next one
writes the same version again. Only two numbers (the versions, the changed entities) reach
the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.config import PanelConfig
from panelkit.operators.features import add_features
from panelkit.operators.resample import resample_fill, resample_last
from panelkit.plans.export import null_non_finite

MANIFEST = "entity string, digest string, data_version int, version int"
Build = Callable[[DataFrame, PanelConfig], dict[str, DataFrame]]


def panel_digests(raw: DataFrame, cfg: PanelConfig) -> DataFrame:
    """entity, digest: equal if and only if (but for hash collisions of about 2^-120) the
    binned series and the settings are. Sums of two hashes with different seeds over the bins,
    so neither the order of rows nor their number per bin matters."""
    def total(seed: str):
        return F.sum(F.xxhash64(F.lit(seed), F.lit(repr(cfg)), "idx", "raw_close").cast("decimal(38,0)")).cast("string")

    return resample_last(raw, cfg.freq).groupBy("entity").agg(
        F.concat_ws(":", F.count("*").cast("string"), total("a"), total("b")).alias("digest"))


def _manifest(spark: SparkSession, out_dir: str) -> DataFrame | None:
    """The last manifest, or None before the first refresh."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{out_dir}/manifest")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    m = spark.read.schema(MANIFEST).parquet(f"{out_dir}/manifest")
    newest = m.agg(F.max("version")).first()[0]  # one number; the filter then prunes folders
    return None if newest is None else m.where(F.col("version") == newest)


def refresh(spark: SparkSession, raw: DataFrame, out_dir: str, build: Build, cfg: PanelConfig | None = None) -> int:
    """Brings the tables under ``out_dir`` up to ``raw``; returns how many entities were
    recomputed. ``build`` maps the features of some entities to tables with an ``entity``
    column that rest on that entity alone (tables over all entities, such as a ranking, are
    not refreshed by parts). An entity that left ``raw`` leaves the manifest; rows without an
    entity are left out."""
    cfg = cfg or PanelConfig()
    raw = raw.where(F.col("entity").isNotNull())
    last = _manifest(spark, out_dir)
    if last is None:
        last, version = spark.createDataFrame([], MANIFEST), 1
    else:
        version = (last.agg(F.max("version")).first()[0] or 0) + 1
    old = last.select("entity", F.col("digest").alias("_digest"), "data_version")
    now = panel_digests(raw, cfg).join(old, "entity", "left")
    fresh = F.col("_digest").isNull() | (F.col("digest") != F.col("_digest"))
    plan = now.select("entity", "digest", F.when(fresh, F.lit(version)).otherwise(F.col("data_version")).alias("data_version"))
    # written first, under a name readers do not look at: the tables and the manifest see one plan
    plan.write.mode("overwrite").parquet(f"{out_dir}/plan/version={version}")
    plan = spark.read.schema("entity string, digest string, data_version int").parquet(f"{out_dir}/plan/version={version}")
    changed = plan.where(F.col("data_version") == version).select("entity")
    n = changed.count()
    if n:
        features = add_features(resample_fill(raw.join(changed, "entity", "left_semi"), cfg), cfg)
        for name, df in build(features, cfg).items():
            null_non_finite(df).write.mode("overwrite").parquet(f"{out_dir}/{name}/version={version}")
    plan.write.mode("overwrite").parquet(f"{out_dir}/manifest/version={version}")
    return n


def current(spark: SparkSession, out_dir: str, name: str) -> DataFrame:
    """The table's rows in force: of every entity those of the version its manifest row names
    (column ``version``). Versions no entity points at are pruned when the join runs."""
    keep = _manifest(spark, out_dir).select("entity", F.col("data_version").alias("version"))
    return spark.read.parquet(f"{out_dir}/{name}").join(keep, ["entity", "version"])
