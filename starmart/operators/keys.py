"""Dimension keys: sequence surrogate keys, stable key assignment, the 'unknown' member (O-33, O-38)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sequence import dense_ids


def assign_keys(
    dim: DataFrame,
    id_cols: Sequence[str],
    key_col: str,
    existing: DataFrame | None = None,
) -> DataFrame:
    """Number dimension rows 1..n by ``id_cols`` (= ROW_NUMBER() OVER (ORDER BY ids) for unique ids).

    With ``existing`` (a previous build holding ``key_col`` and ``id_cols``), ids already known keep
    their key and new ids are numbered after the current maximum, so stored facts never go stale.
    """
    if existing is None:
        ids = dense_ids(dim, list(id_cols), key_col)
        return dim.join(ids, list(id_cols), "left").select(key_col, *dim.columns)
    old = existing.select(*id_cols, key_col)
    new_ids = dim.select(*id_cols).distinct().join(old, list(id_cols), "left_anti")
    numbered = dense_ids(new_ids, list(id_cols), "_sm_newkey")
    top = old.agg(F.coalesce(F.max(key_col), F.lit(0))).scalar()  # uncorrelated scalar subquery
    fresh = numbered.select(*id_cols, (top + F.col("_sm_newkey")).cast("bigint").alias(key_col))
    keys = old.unionByName(fresh)
    return dim.join(keys, list(id_cols), "left").select(key_col, *dim.columns)


def with_unknown_member(dim: DataFrame, member: Mapping[str, object]) -> DataFrame:
    """Prepend the constant 'unknown' row (key 0) to a dimension (UNION ALL)."""
    spark = dim.sparkSession
    types = {f.name: f.dataType for f in dim.schema.fields}
    row = spark.range(1).select(*[F.lit(member.get(c)).cast(types[c]).alias(c) for c in dim.columns])
    return row.unionByName(dim)
