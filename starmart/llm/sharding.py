"""Sharding: a uniform shuffle into shards of exact size, by a hypergeometric communication matrix.

1. The rows' keys are written once with the number of the partition that read them, so that every
   later step and every repeated task sees the same partitions.
2. From the partitions' row counts the matrix "rows of partition p that go to shard s" is drawn:
   row by row, multivariate hypergeometric from the room that is left in the shards.  Its row sums
   are the partitions' counts, its column sums the wanted shard sizes, both exactly.
3. Each partition permutes its rows at random and deals them out by its row of the matrix.
4. After the exchange each shard permutes its rows again.  A shard is not sorted in one task: its
   rows go to buckets by a random 64-bit number, buckets are ordered inside, and a bucket's first
   slot is the number of rows in the shard's earlier buckets.

Every assignment with these shard sizes is equally likely, and so is every order inside a shard
(up to the quality of the 64-bit numbers).

What the driver holds is one count per input partition and the matrix (24 numbers per partition),
never rows.

Edge cases: null ids and texts are rows like any other (a null text has no bytes); equal rows and
equal ids are told apart by where they were read; shards may be empty if there are fewer rows than
shards; an empty table gives an empty result; columns that are not asked for are not read.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

#: numpy draws exactly below this population; beyond it the draw is by inversion from the mode.
NUMPY_POPULATION = 1_000_000_000
#: Rows of a bucket of a shard, on average.
BUCKET_ROWS = 250_000


def hypergeometric(rng: np.random.Generator, good: int, bad: int, sample: int) -> int:
    """How many of ``sample`` balls drawn without replacement are good."""
    if good + bad < NUMPY_POPULATION:
        return int(rng.hypergeometric(good, bad, sample)) if sample else 0
    low, high = max(0, sample - bad), min(good, sample)
    mode = min(high, max(low, (sample + 1) * (good + 1) // (good + bad + 2)))

    def log_choose(n: int, k: int) -> float:
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)

    at_mode = math.exp(log_choose(good, mode) + log_choose(bad, sample - mode) - log_choose(good + bad, sample))
    left, up, down, p_up, p_down = rng.random() - at_mode, mode, mode, at_mode, at_mode
    while left > 0 and (up < high or down > low):
        if up < high:
            p_up *= (good - up) / (up + 1) * (sample - up) / (bad - sample + up + 1)
            up += 1
            left -= p_up
            if left <= 0:
                return up
        if down > low:
            p_down *= down / (good - down + 1) * (bad - sample + down) / (sample - down + 1)
            down -= 1
            left -= p_down
            if left <= 0:
                return down
    return mode


def even_sizes(rows: int, shards: int) -> list[int]:
    """Shard sizes that differ by one at most."""
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def communication_matrix(counts: Sequence[int], sizes: Sequence[int], seed: int) -> list[list[int]]:
    """Row p, column s: rows of partition p that go to shard s."""
    if sum(counts) != sum(sizes):
        raise ValueError("partition counts and shard sizes must have the same sum")
    rng, room, out = np.random.default_rng(seed), list(sizes), []
    for n in counts:
        rest, row = sum(room), []
        for s, free in enumerate(room):
            rest -= free
            k = hypergeometric(rng, free, rest, n)
            row.append(k)
            n -= k
            room[s] -= k
        out.append(row)
    return out


def assign_shards(df: DataFrame, keys: dict[str, Column], shards: int = 24, seed: int = 7) -> DataFrame:
    """The columns ``keys`` of every row with its shard (int) and slot (long, gapless from 0 per shard)."""
    spark, names = df.sparkSession, list(keys)
    slim = df.select(F.struct(*[c.alias(n) for n, c in keys.items()]).alias("row"), F.spark_partition_id().alias("part"),
                     F.monotonically_increasing_id().alias("place"))
    slim = materialize(slim, "shard_keys")
    counts = {r["part"]: r["n"] for r in slim.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts, total = sorted(counts), sum(counts.values())
    matrix = communication_matrix([counts[p] for p in parts], even_sizes(total, shards), seed)

    # Local permutation, then the matrix row as upper bounds of ranks.
    bounds = spark.createDataFrame(
        [(p, [int(x) for x in np.cumsum(row)]) for p, row in zip(parts, matrix, strict=True)],
        T.StructType([T.StructField("part", T.IntegerType()), T.StructField("bounds", T.ArrayType(T.LongType()))]),
    )
    local = Window.partitionBy("part").orderBy(F.xxhash64("place", F.lit(seed), F.lit("local")), "place")
    dealt = slim.withColumn("rank", F.row_number().over(local)).join(bounds, "part")
    dealt = dealt.withColumn("shard", F.size(F.filter("bounds", lambda b: b < F.col("rank"))).cast("int"))

    # Exchange by (shard, bucket) and the second permutation.
    n_buckets = max(1, -(-total // (shards * BUCKET_ROWS)))
    lot = F.xxhash64("place", F.lit(seed), F.lit("slot"))
    dealt = dealt.select("row", "place", "shard", lot.alias("lot")).withColumn("bucket", F.pmod("lot", F.lit(n_buckets)).cast("int"))
    dealt = materialize(dealt, "shard_dealt")
    first = dealt.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = first.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("shard", "bucket").orderBy("lot", "place")
    out = dealt.withColumn("at", F.row_number().over(inside)).join(first, ["shard", "bucket"])
    return out.select(*[F.col(f"row.{n}").alias(n) for n in names], "shard", (F.col("first") + F.col("at") - 1).cast("bigint").alias("slot"))


def write_shards(df: DataFrame, path: str, id_col: str, shards: int = 24, seed: int = 7) -> None:
    """The rows themselves, one folder ``shard=...`` each, in slot order per file; ``id_col`` must be unique."""
    placed = assign_shards(df, {"shard_row_id": F.col(id_col)}, shards, seed)
    rows = df.join(placed, F.col(id_col).eqNullSafe(F.col("shard_row_id"))).drop("shard_row_id")
    spread = F.floor(F.col("slot") / BUCKET_ROWS)
    rows.repartition(F.col("shard"), spread).sortWithinPartitions("shard", "slot").write.mode("overwrite").partitionBy("shard").parquet(path)
