"""Helpers shared by the operators: words, shared-folder tables, Arrow loops."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelkit.session import checkpoint_dir

#: Output of a Python step is handed over whenever so much has gathered.
FLUSH_BYTES = 8 << 20


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder (``spark.checkpoint.dir``) and read it
    back: lineage ends there and survives the loss of any executor."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def crc_mod(id_col: str, n: int):
    """crc32 of the id as decimal text, mod ``n`` (a stable fold)."""
    return F.crc32(F.col(id_col).cast("string")) % n


class Rows:
    """Column buffers that become record batches of bounded size."""

    def __init__(self, schema: pa.Schema, limit: int = FLUSH_BYTES):
        self.schema, self.limit = schema, limit
        self._clear()

    def _clear(self) -> None:
        self.cols: list[list] = [[] for _ in self.schema]
        self.size = 0

    def add(self, size: int, *values) -> None:
        for c, v in zip(self.cols, values):
            c.append(v)
        self.size += size + 16

    def full(self) -> bool:
        return self.size >= self.limit

    def take(self) -> pa.RecordBatch:
        out = pa.record_batch([pa.array(c, f.type) for c, f in zip(self.cols, self.schema)], schema=self.schema)
        self._clear()
        return out


def out_schema(ddl: str, df: DataFrame, carry: str | None) -> StructType:
    """Columns of ``ddl``, and the carried one."""
    out = StructType.fromDDL(ddl)
    return out.add(df.schema[carry]) if carry else out


def map_rows(df: DataFrame, schema: pa.Schema, ddl: str,
             start: Callable[[], Callable[..., Iterator[tuple]]], carry: str | None = None) -> DataFrame:
    """``mapInArrow`` over the columns of ``df``: ``start()`` runs once per task
    and returns a function from one row's values to output tuples
    ``(size_in_bytes, value, ...)``. Batches leave as soon as they are full, so a
    task holds no more than one input batch and ``FLUSH_BYTES`` of output.
    ``carry`` names the last column of ``df``, which goes through untouched; each
    row then gives one output."""

    def run(batches):
        each, rows = start(), Rows(schema)
        for b in batches:
            columns = b.columns[:-1] if carry else b.columns
            done = 0
            for at, values in enumerate(zip(*(c.to_pylist() for c in columns))):
                for out in each(*values):
                    rows.add(*out)
                if rows.full() or carry and at + 1 == b.num_rows:
                    if carry:
                        yield pa.RecordBatch.from_arrays([*rows.take().columns, b.columns[-1].slice(done, at + 1 - done)], [*schema.names, carry])
                        done = at + 1
                    else:
                        yield rows.take()
        if not carry:
            yield rows.take()

    return df.mapInArrow(run, out_schema(ddl, df, carry))
