"""Embedding near-duplicates by E8 lattice hashing.

Vectors of one label are normalised, projected at random onto ``tables`` x 8
dimensions and decoded to the nearest point of the E8 lattice, a cell of nearly
round shape. In each table a vector is stored in its own cell and probes the
``probes`` neighbouring cells nearest to it; whatever meets in a cell is verified
by its cosine in double precision. A pair at the threshold meets in at least one
table with a probability above 0.99 (measured in the tests).

Equal vectors become one class before anything else. A cell with more than
``block`` rows is compared in blocks by several tasks, completely. Links between
classes come out once; copies count in ``n_links`` without being expanded.

Null, zero or non-finite vectors, null labels and vectors of another length link
with nothing (``n_links`` 0, own component, kept). Repeated rows are copies. Only
the id, the vector and the label are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import materialize
from panelkit.llm.components import components
from panelkit.llm.substr import mix
from panelkit.llm.tokcount import groups

SEED = 20


def roots() -> np.ndarray:
    """The 240 shortest vectors of E8, doubled to integers."""
    out = []
    for i in range(8):
        for j in range(i):
            for a in (-2, 2):
                for b in (-2, 2):
                    v = np.zeros(8, np.int64)
                    v[i], v[j] = a, b
                    out.append(v)
    signs = 1 - 2 * (np.arange(256)[:, None] >> np.arange(8) & 1)
    return np.concatenate([out, signs[(signs < 0).sum(1) % 2 == 0]])


ROOTS = roots()


def _even(x: np.ndarray) -> np.ndarray:
    """Nearest integer point with an even sum."""
    f = np.rint(x)
    odd = np.flatnonzero(f.sum(1) % 2 != 0)
    gap = x[odd] - f[odd]
    k = np.abs(gap).argmax(1)
    rows = np.arange(len(odd))
    f[odd, k] += np.where(gap[rows, k] >= 0, 1, -1)
    return f


def decode(x: np.ndarray) -> np.ndarray:
    """Nearest E8 point of each row, doubled to integers: even sums, or those shifted by one half."""
    a, b = _even(x), _even(x - 0.5) + 0.5
    near = ((x - a) ** 2).sum(1) <= ((x - b) ** 2).sum(1)
    return np.rint(2 * np.where(near[:, None], a, b)).astype(np.int64)


def neighbours(x: np.ndarray, cell: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` neighbouring cells nearest to each row: ``[rows, n, 8]``."""
    step = (2 * x - cell) @ ROOTS.T  # larger: nearer, as all roots are equally long
    best = np.argpartition(-step, n - 1, axis=1)[:, :n] if n else np.zeros((len(x), 0), int)
    return cell[:, None, :] + ROOTS[best]


def cell_key(cell: np.ndarray, salt: np.ndarray) -> np.ndarray:
    h = salt.astype(np.uint64)
    for k in range(8):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + cell[..., k].astype(np.uint64))
    return h.view(np.int64)


def projections(dim: int, tables: int, scale: float) -> np.ndarray:
    return np.random.default_rng([SEED, dim]).normal(0, scale, (tables, dim, 8))


def unit(vectors: list, dim: int) -> np.ndarray:
    x = np.frombuffer(b"".join(vectors), np.float64).reshape(-1, dim)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def prepare(rows: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """``(id, label, dim, vec)`` of usable rows: ``vec`` as packed doubles."""
    schema = pa.schema([("id", pa.int64()), ("label", pa.string()), ("dim", pa.int32()), ("vec", pa.binary())])

    def run(batches):
        for b in batches:
            out = []
            for key, v, label in zip(*(c.to_pylist() for c in b.columns)):
                if key is None or label is None or not v or None in v:
                    continue
                x = np.array(v, np.float64) + 0.0
                if np.isfinite(x).all() and 0 < np.linalg.norm(x) < np.inf:
                    out.append((key, label, len(v), x.tobytes()))
            yield pa.record_batch([pa.array([o[k] for o in out], f.type) for k, f in enumerate(schema)], schema=schema)

    return rows.select(rows[id_col].cast("long"), rows[vec_col].cast("array<double>"), rows[label_col].cast("string")).mapInArrow(
        run, "id long, label string, dim int, vec binary")


def links(classes: DataFrame, threshold: float = 0.93, tables: int = 8, probes: int = 5, scale: float | None = None, block: int = 4096) -> DataFrame:
    """``(a, b)``, ``a < b``: distinct links between rows of ``(id, label, dim, vec)``."""
    scale = scale or 0.62 / np.sqrt(8 * (2 - 2 * threshold))
    spark = classes.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = pa.schema([("key", pa.int64()), ("id", pa.int64()), ("probe", pa.bool_())])

    def code(batches):
        import zlib

        for b in batches:
            dims = b.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                part = b.filter(pa.array(dims == dim))
                x, ids = unit(part.column("vec").to_pylist(), dim), part.column("id").to_numpy()
                salt = np.array([zlib.crc32(f"{dim} {l}".encode()) for l in part.column("label").to_pylist()], np.uint64)
                for t, p in enumerate(projections(dim, tables, scale)):
                    y = x @ p
                    cell = decode(y)
                    own = cell_key(cell, salt << np.uint64(8) | np.uint64(t))
                    near = cell_key(neighbours(y, cell, probes), np.repeat((salt << np.uint64(8) | np.uint64(t))[:, None], probes, 1)).ravel()
                    yield pa.record_batch([pa.array(np.r_[own, near]), pa.array(np.r_[ids, np.repeat(ids, probes)]),
                                           pa.array(np.arange(len(own) + len(near)) >= len(own))], schema=schema)

    codes = materialize(classes.repartition(n, "id").mapInArrow(code, "key long, id long, probe boolean"), "cells")
    size = codes.groupBy("key").agg(F.count("*").alias("rows"), F.sum((~F.col("probe")).cast("int")).alias("stored")).where("stored > 0 and rows > 1")
    # a large cell: rows fall into chunks, every two chunks meet in one block
    parts = F.ceil(F.col("rows") / F.lit(block)).cast("int")
    chunk = F.when(parts > 1, F.pmod(F.xxhash64("id"), parts)).otherwise(0).cast("int")
    met = (codes.join(size, "key").withColumn("chunk", chunk).withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
           .select("key", "id", "probe", "chunk", F.least("chunk", "other").alias("lo"), F.greatest("chunk", "other").alias("hi"))
           .withColumn("cell", F.xxhash64("key", "lo", "hi")))
    rows = met.join(classes.select("id", "dim", "label", "vec"), "id")

    def compare(batches):
        held_pairs, size = [], 0

        def flush():
            pairs = np.unique(np.concatenate(held_pairs), axis=0) if held_pairs else np.zeros((0, 2), np.int64)
            held_pairs.clear()
            return pa.record_batch([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

        for held in groups(batches, "cell"):
            t = pa.Table.from_batches(held)
            ids, probe, chunk, lo, hi = (t.column(c).to_numpy() for c in ("id", "probe", "chunk", "lo", "hi"))
            dims, labels = t.column("dim").to_numpy(), t.column("label").to_numpy()
            if probe.all() or len(ids) < 2 or (dims != dims[0]).any() and len(set(dims.tolist())) == len(dims):
                continue
            for dim in set(dims.tolist()):
                own = np.flatnonzero(dims == dim)
                x = unit([t.column("vec")[int(k)].as_py() for k in own], dim)
                i, p, c, l = ids[own], probe[own], chunk[own], labels[own]
                left, right = np.flatnonzero((c == lo[own]) & ~p), np.flatnonzero(c == hi[own])
                sides = [(left, right)]
                if (lo != hi).any():
                    sides.append((np.flatnonzero((c == hi[own]) & ~p), np.flatnonzero((c == lo[own]) & p)))
                for u, v in sides:
                    for at in range(0, len(u), 1024):
                        some = u[at:at + 1024]
                        r, s = np.nonzero(x[some] @ x[v].T >= threshold)
                        a, b = i[some[r]], i[v[s]]
                        ok = (a != b) & (l[some[r]] == l[v[s]])
                        if ok.any():
                            pairs = np.unique(np.stack([np.minimum(a[ok], b[ok]), np.maximum(a[ok], b[ok])], 1), axis=0)
                            held_pairs.append(pairs)
                            size += len(pairs)
                if size > 1 << 20:
                    yield flush()
                    size = 0
        yield flush()

    out = rows.repartition(n, "cell").sortWithinPartitions("cell").select("cell", "id", "probe", "chunk", "lo", "hi", "dim", "label", "vec")
    return out.mapInArrow(compare, "a long, b long").distinct()


def near_duplicates(rows: DataFrame, threshold: float = 0.93, tables: int = 8, probes: int = 5, block: int = 4096,
                    id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``(id, n_links, component_id, kept)`` per row."""
    usable = materialize(prepare(rows, id_col, vec_col, label_col), "vectors")
    classes = materialize(usable.groupBy("label", "dim", "vec").agg(F.min("id").alias("id"), F.count("*").alias("copies")), "classes")
    pairs = materialize(links(classes, threshold, tables, probes, None, block), "links")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = both.join(classes.select(F.col("id").alias("b"), "copies"), "b").groupBy("a").agg(F.sum("copies").alias("others"))
    roots = components(pairs)
    known = (classes.join(others, F.col("id") == F.col("a"), "left").join(roots, F.col("id") == F.col("node"), "left")
             .select("label", "dim", "vec", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "id").alias("component_id")))
    linked = usable.join(known, ["label", "dim", "vec"]).groupBy(F.col("id").alias("linked_id")).agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    own = rows.select(rows[id_col].cast("long").alias("own_id"))
    return (own.join(linked, F.col("own_id") == F.col("linked_id"), "left")
            .select(F.col("own_id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "own_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True))))
