"""Centroid clustering over whole numbers, in JVM expressions.

Components become floor(scale * x). The squared distance to a centroid is
``aggregate`` over ``zip_with`` of the vector and the centroid as a literal array;
``array_min`` over (distance, number) structs chooses the cluster, the smaller
number on ties. A round is one grouped aggregate: a count and one column sum per
component, summed within each task first, so that k rows a task move and k rows
reach the driver, which puts the exact floor(sum / count) into the next round's
literals. An empty cluster keeps its centroid. The vectors are turned into whole
numbers once and written; the rounds read that.

A vector is kept if it has exactly ``dims`` components, none null, NaN or infinite,
and none beyond +-2^17 at scale 1024 (``MOST``: distances beyond don't fit 64 bits).
Repeated rows count each; ties among starting vectors (equal ids) go by the
components, null ids start last. Fewer than k vectors give fewer clusters, an empty
table none. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import materialize

#: Largest whole number a component may have: 64 squared differences stay below 2^63.
MOST = 1 << 27


class Clustering(NamedTuple):
    #: ``(id, cluster int, distance long)`` per kept vector
    assigned: DataFrame
    #: the final centroids, by number
    centroids: list[list[int]]
    #: the distances summed by cluster; a cluster without vectors is left out
    inertia: dict[int, int]

    def digest(self, cluster: int) -> str:
        return hashlib.sha256(",".join(map(str, self.centroids[cluster])).encode()).hexdigest()


def whole_vectors(vectors: DataFrame, dims: int = 64, scale: int = 1024, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(id, v array<long>)`` of the kept vectors."""
    v = F.col(f"`{vec_col}`")
    fits = F.forall(v, lambda x: x.isNotNull() & (F.abs(x.cast("double")) <= F.lit(MOST / scale)))  # (NaN is above all)
    kept = vectors.where(v.isNotNull() & (F.size(v) == dims) & fits)
    return kept.select(F.col(f"`{id_col}`").alias("id"), F.transform(v, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long")).alias("v"))


def start(kept: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The k vectors whose ids have the least hashes."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256).asc_nulls_last()
    return [list(r.v) for r in kept.orderBy(order, "v").limit(k).collect()]


def distance(v: Column, centroid: list[int]) -> Column:
    literal = F.expr(f"array({', '.join(f'{x}L' for x in centroid)})")
    return F.aggregate(F.zip_with(v, literal, lambda a, b: (a - b) * (a - b)), F.lit(0).cast("long"), lambda s, x: s + x)


def nearest(centroids: list[list[int]]) -> Column:
    """A struct of the least distance and the cluster it belongs to."""
    return F.array_min(F.array(*[F.struct(distance(F.col("v"), c).alias("distance"), F.lit(n).alias("cluster")) for n, c in enumerate(centroids)]))


def step(kept: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The next centroids."""
    dims = len(centroids[0])
    sums = (kept.select(nearest(centroids)["cluster"].alias("cluster"), "v").groupBy("cluster")
            .agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col("v")[i]).alias(f"s{i}") for i in range(dims)])).collect()
    out = list(centroids)
    for row in sums:
        out[row.cluster] = [row[f"s{i}"] // row.n for i in range(dims)]
    return out


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: int = 3,
            id_col: str = "vec_id", vec_col: str = "embedding") -> Clustering:
    kept = materialize(whole_vectors(vectors, dims, scale, id_col, vec_col), "vectors")
    centroids = start(kept, k, seed)
    if not centroids:
        return Clustering(kept.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), [], {})
    for _ in range(rounds):
        centroids = step(kept, centroids)
    assigned = materialize(kept.select("id", nearest(centroids).alias("best")).select("id", "best.cluster", "best.distance"), "assigned")
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("s")).collect()
    return Clustering(assigned, centroids, {r.cluster: int(r.s) for r in sums})


def report(found: Clustering) -> DataFrame:
    """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` per
    kept vector; an inertia that doesn't fit 64 bits is null."""
    fits = lambda x: F.lit(x if abs(x) < 1 << 63 else None).cast("long")
    numbers = range(len(found.centroids))
    by_cluster = lambda values: F.element_at(F.array(*values), F.col("cluster") + 1) if found.centroids else F.lit(None)
    return found.assigned.select(F.col("id").alias("vec_id"), "cluster", "distance",
                                 by_cluster([fits(found.inertia.get(n, 0)) for n in numbers]).cast("long").alias("cluster_inertia"),
                                 fits(sum(found.inertia.values())).alias("inertia"),
                                 by_cluster([F.lit(found.digest(n)) for n in numbers]).cast("string").alias("centroid_sha256"))
