"""Centroid clustering of integer vectors with JVM expressions only.

Vectors become integers once (floor of ``scale`` times each component, as double) and are written.
In each round every vector is compared with the literal centroid arrays: ``zip_with`` gives the
squared differences, ``aggregate`` adds them up, ``array_min`` over (distance, number) structs picks
the nearest centroid, ties going to the smaller number.  The new centroids are column sums: one
aggregate with a sum per component, grouped by cluster and combined before its exchange, so a
cluster of any size sends one row per task.  Only k rows of sums come to the driver.  All arithmetic
is on longs and decimals, so results don't depend on the order of the rows.

Edge cases: null vectors, vectors of another length and those with null, NaN or infinite components
are left out; components whose integer goes beyond +-2^27 count as +-2^27, so that a squared
distance of up to 128 components always fits a long (sums of distances beyond a long count as the largest one); repeated rows count each, equal ids too (ties
of the starting order go by the components); a null id counts as the empty text there; with fewer
than k vectors each one starts a centroid; without any the result is empty; other columns are ignored.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

#: Largest integer component: 128 * (2 * 2^27)^2 < 2^63.
LARGEST = 1 << 27
LARGEST_LONG = (1 << 63) - 1


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, dim: int, scale: int) -> DataFrame:
    """``vec_id`` and ``q`` (array of long) of the vectors with exactly ``dim`` finite components."""
    x = F.col(vector_col).cast("array<double>")
    usable = (F.size(x) == dim) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    within = lambda v: F.least(F.greatest(F.floor(v), F.lit(-LARGEST)), F.lit(LARGEST)).cast("bigint")
    ints = F.transform(x, lambda v: within(F.lit(float(scale)) * F.least(F.greatest(v, F.lit(-2.0**40)), F.lit(2.0**40))))
    return df.filter(F.coalesce(usable, F.lit(False))).select(F.col(id_col).alias("vec_id"), ints.alias("q"))


def nearest(centroids: list[list[int]], q: str = "q") -> Column:
    """Struct (distance, cluster) of the centroid nearest to the column ``q``; one expression text, so that it is built in one call."""
    squares = [f"zip_with({q}, array({', '.join(f'{x}L' for x in c)}), (a, b) -> (a - b) * (a - b))" for c in centroids]
    each = [f"named_struct('distance', aggregate({x}, 0L, (s, d) -> s + d), 'cluster', {k})" for k, x in enumerate(squares)]
    return F.expr(f"array_min(array({', '.join(each)}))")


def starting_centroids(vectors: DataFrame, k: int, seed: str) -> list[list[int]]:
    """The k vectors whose ids have the smallest hashes."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    return [r["q"] for r in vectors.select("q", key.alias("h")).orderBy("h", "q").limit(k).collect()]


def moved_centroids(vectors: DataFrame, centroids: list[list[int]], dim: int) -> list[list[int]]:
    """One round: floor of the componentwise mean of each centroid's vectors; empty ones stay."""
    assigned = vectors.select("q", nearest(centroids)["cluster"].alias("cluster"))
    sums = assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *[F.expr(f"sum(q[{i}]) AS s{i}") for i in range(dim)])
    moved = [list(c) for c in centroids]
    for r in sums.collect():
        moved[r["cluster"]] = [r[f"s{i}"] // r["n"] for i in range(dim)]
    return moved


def cluster(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dim: int = 64, k: int = 8, rounds: int = 10,
            scale: int = 1024, seed: str = "3") -> tuple[DataFrame, list[list[int]]]:
    """``vec_id``, ``cluster`` (int) and ``distance`` (long, squared) per usable vector, and the centroids."""
    vectors = materialize(integer_vectors(df, id_col, vector_col, dim, scale), "centroid_vectors")
    centroids = starting_centroids(vectors, k, seed)
    if not centroids:
        return vectors.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance")), []
    for _ in range(rounds):
        moved = moved_centroids(vectors, centroids, dim)
        if moved == centroids:
            break  # further rounds would change nothing
        centroids = moved
    at = vectors.select("vec_id", nearest(centroids).alias("at"))
    return materialize(at.select("vec_id", "at.cluster", "at.distance"), "centroid_clusters"), centroids


def with_inertia(clusters: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """Adds ``cluster_inertia``, ``inertia`` and ``centroid_sha256``, k figures each, as literals."""
    total = F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")
    sums = {r["cluster"]: int(r["s"]) for r in clusters.groupBy("cluster").agg(total).collect()}
    each = [min(sums.get(c, 0), LARGEST_LONG) for c in range(max(1, len(centroids)))]
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids] or [""]
    pick = lambda values, kind: F.element_at(F.lit(values).cast(f"array<{kind}>"), F.col("cluster") + 1)
    return clusters.select("vec_id", "cluster", "distance", pick(each, "bigint").alias("cluster_inertia"), F.lit(min(sum(sums.values()), LARGEST_LONG)).cast("bigint").alias("inertia"),
                           pick(digests, "string").alias("centroid_sha256"))
