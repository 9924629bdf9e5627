"""The exported documents (K7, K10, S15): one JSON document per entity plus the run's own tables.

The schema ``DOCUMENT`` alone says how a section nests. A section is built from one
long table by walking its type: an array of structs holds the table's rows in the order of
their fields, a map holds what follows once per ``model``, a struct takes columns that are
constant within its key. Every level is one ``groupBy`` on ``entity`` or
``(entity, model)``, so an entity's document is bounded by its calendar and the number of
models. What covers all entities (metadata, ranking) stays a table of rows: no id list
is gathered into one cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.config import PanelConfig
from panelkit.functions.scalar import finite_or_null
from panelkit.schema import DOCUMENT, METADATA, MODEL_RANKING, OVERALL, RANKING

#: The table of ``runner.run`` that each section is built from, under the section's name.
SECTIONS = {"kpis": "kpis", "series": "series", "decomposition": "decomposition", "stationarity": "stationarity",
            "outliers": "outliers", "outlier_summary": "outlier_summary", "residual_stats": "residual_stats",
            "forecast": "price_forecast", "residuals": "model_residuals", "comparison": "model_comparison",
            "models": "model_summary"}
#: The tables of rows beside the documents, with their schemas.
RUN_TABLES = {"metadata": METADATA, "best_worst": OVERALL, "ranking": RANKING, "model_ranking": MODEL_RANKING}


def _collects(dtype: T.DataType) -> bool:
    """Whether values of this type gather several rows of the section's table."""
    return isinstance(dtype, T.MapType) or (isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType))


def _field(table: DataFrame, field: T.StructField) -> Column:
    """A column of the table in the schema's type, non-finite numbers null; null where the table has none."""
    if field.name not in table.columns:
        return F.lit(None).cast(field.dataType).alias(field.name)
    c = F.col(f"`{field.name}`").cast(field.dataType)
    return (finite_or_null(c) if isinstance(field.dataType, T.DoubleType) else c).alias(field.name)


def nest(table: DataFrame, keys: list[str], dtype: T.DataType, name: str) -> DataFrame:
    """``keys`` and one column ``name`` of type ``dtype`` per key, built from the rows of ``table``."""
    if isinstance(dtype, T.MapType):
        inner = nest(table, [*keys, "model"], dtype.valueType, "value").where(F.col("model").isNotNull())
        pairs = F.array_sort(F.collect_list(F.struct("model", "value")))
        return inner.groupBy(*keys).agg(F.map_from_entries(pairs).alias(name))
    if isinstance(dtype, T.ArrayType):
        row = F.struct(*[_field(table, f) for f in dtype.elementType.fields])
        return table.groupBy(*keys).agg(F.array_sort(F.collect_list(row)).alias(name))
    if not any(_collects(f.dataType) for f in dtype.fields):
        return table.select(*keys, F.struct(*[_field(table, f) for f in dtype.fields]).alias(name))
    constants = [f for f in dtype.fields if not _collects(f.dataType)]
    out = table.groupBy(*keys).agg(*[F.first(_field(table, f)).alias(f.name) for f in constants])
    for f in dtype.fields:
        if _collects(f.dataType):
            out = out.join(nest(table, keys, f.dataType, f.name), keys, "left")
    return out.select(*keys, F.struct(*[F.col(f"`{f.name}`") for f in dtype.fields]).alias(name))


def document(spark: SparkSession, tables: dict[str, DataFrame], schema: str = DOCUMENT) -> DataFrame:
    """K7: one document per entity of ``tables["kpis"]``; sections without a table are left
    out, an entity without rows in a section has null there."""
    fields = [f for f in T.StructType.fromDDL(schema).fields if f.name != "entity"]
    out = None
    for f in sorted(fields, key=lambda f: f.name != "kpis"):  # the KPIs say which entities there are
        if SECTIONS[f.name] in tables:
            section = nest(tables[SECTIONS[f.name]], ["entity"], f.dataType, f.name)
            out = section if out is None else out.join(section, "entity", "left")
    return out.select("entity", *[f.name for f in fields if f.name in out.columns])


def metadata(features: DataFrame, cfg: PanelConfig) -> DataFrame:
    """A row per entity: its span, and the settings of the run."""
    return features.groupBy("entity").agg(
        F.min("ts").cast("timestamp").alias("first_date"), F.max("ts").cast("timestamp").alias("last_date"),
        F.count("*").alias("n_periods"), F.count("close").alias("n_values")).select(
        "*", F.lit("close").alias("value_column"), F.lit(cfg.freq).alias("resample_freq"),
        F.lit(cfg.horizon).alias("forecast_horizon"), F.lit(cfg.seasonal_period).alias("seasonal_period"))


def model_ranking(summary: DataFrame) -> DataFrame:
    """The models with an AIC, in order of it (a row per entity, ranked)."""
    return summary.where(F.col("aic").isNotNull()).select("entity", "order", "aic", F.col("aic_rank").alias("rank"))


def write_documents(spark: SparkSession, tables: dict[str, DataFrame], path: str, cfg: PanelConfig | None = None) -> None:
    """The documents under ``entities`` and each of ``RUN_TABLES`` that the run has, as JSON lines."""
    from panelkit.plans.export import write_table

    run = dict(tables)
    if "features" in run and cfg is not None and "metadata" not in run:
        run["metadata"] = metadata(run["features"], cfg)
    if "model_summary" in run:
        run["model_ranking"] = model_ranking(run["model_summary"])
    write_table(document(spark, tables), f"{path}/entities", "json")
    for name, ddl in RUN_TABLES.items():
        if name in run:
            fields = T.StructType.fromDDL(ddl).fields
            write_table(run[name].select(*[_field(run[name], f) for f in fields]), f"{path}/{name}", "json")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """The documents of ``write_documents``."""
    from panelkit.plans.export import read_document

    return read_document(spark, f"{path}/entities")


def read_run_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One of ``RUN_TABLES`` of ``write_documents``."""
    return spark.read.schema(RUN_TABLES[name]).json(f"{path}/{name}")
