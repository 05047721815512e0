"""Temporal joins over half-open validity intervals (O-18 .. O-20).

``temporal_join`` joins two SCD-2 histories on a key and on overlapping validity and returns the
*intersection* of the intervals.  ``pit_join`` attaches to each fact the dimension version valid at
the fact's time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sequence import hot_keys, with_forward_fill, with_neighbors, with_position


def temporal_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    attributes: Sequence[str],
    prefix: str,
    gaps: str = "keep",
    left_from: str = "valid_from",
    left_to: str = "valid_to",
    right_from: str = "valid_from",
    right_to: str = "valid_to",
    strategy: str = "join",
) -> DataFrame:
    """Left temporal join of two histories.

    Output: left columns without its bounds, ``<prefix>__<attr>`` for every right attribute, and
    ``valid_from``/``valid_to`` = the intersection of the two intervals.  Overlap is strict
    (``r.to > l.from AND r.from < l.to``), so versions that only touch give no empty row.

    * a left row with no overlapping right version (or a NULL key) is kept whole, attributes NULL;
    * ``gaps="keep"`` also emits the parts of a matched left interval that no right version covers
      (head, holes, tail), so the output tiles every left interval exactly once;
    * ``gaps="drop"`` emits only the overlaps (and the whole unmatched rows).

    Plan: one equi-join on the key with the overlap as residual.  The right side first learns the
    end of its predecessor and the start of its successor (one skew-safe neighbour pass over the
    right table), so every joined row can emit, in one ``explode``, its segment, the uncovered
    stretch before it and - if it is the last version overlapping the left row - the tail.  No
    window over the joined rows, and each input is read once.

    ``strategy="ranked"`` avoids the equi-join's cost of (left rows x right versions) inside one
    key, which matters when a key is hot on both sides: right versions get their position within
    the key, each left row finds the first and last overlapping position by two as-of lookups
    (skew-safe forward fills over the union of both sides), explodes exactly that range and
    joins on (key, position).  Work is O(n log n + output); left rows may overlap each other.

    Right versions of one key must not overlap each other (a valid SCD-2 table; see
    ``checks.scd_overlaps``).
    """
    if gaps not in ("keep", "drop"):
        raise ValueError("gaps must be 'keep' or 'drop'")
    if strategy not in ("join", "ranked"):
        raise ValueError("strategy must be 'join' or 'ranked'")
    body = [c for c in left.columns if c not in (left_from, left_to)]
    out_attrs = [f"{prefix}__{a}" for a in attributes]
    lf, lt = F.col("_sm_lf"), F.col("_sm_lt")
    L = left.select(*[F.col(f"`{c}`") for c in body], F.col(left_from).alias("_sm_lf"), F.col(left_to).alias("_sm_lt"))
    R = right.select(
        F.col(right_key).alias("_sm_rk"),
        F.col(right_from).alias("_sm_rf"),
        F.col(right_to).alias("_sm_rt"),
        F.struct(*[F.col(a).alias(o) for a, o in zip(attributes, out_attrs)]).alias("_sm_attrs"),
    )
    if gaps == "keep":
        R = with_neighbors(R, ["_sm_rk"], ["_sm_rf"], ["_sm_rt", "_sm_rf"], prev="_sm_p", next="_sm_n")
    if strategy == "join":
        cond = (F.col(left_key) == F.col("_sm_rk")) & (F.col("_sm_rt") > lf) & (F.col("_sm_rf") < lt)
        j = L.join(R, cond, "left")
    else:
        j = _ranked_overlaps(L, R, left_key, body)

    matched = F.col("_sm_rk").isNotNull()
    rf, rt = F.col("_sm_rf"), F.col("_sm_rt")
    none = F.lit(None).cast(R.schema["_sm_attrs"].dataType)

    def piece(frm, to, attrs):
        return F.struct(frm.alias("f"), to.alias("t"), attrs.alias("a"))

    main = F.when(matched, piece(F.greatest(lf, rf), F.least(lt, rt), F.col("_sm_attrs"))).otherwise(piece(lf, lt, none))
    pieces = [main]
    if gaps == "keep":
        prev_to = F.col("_sm_p._sm_rt")
        next_from = F.col("_sm_n._sm_rf")
        before = piece(F.greatest(lf, F.coalesce(prev_to, lf)), rf, none)
        is_last = next_from.isNull() | (next_from >= lt)
        tail = piece(rt, lt, none)
        pieces += [F.when(matched, before), F.when(matched & is_last, tail)]
    exploded = j.select(*[F.col(f"`{c}`") for c in body], F.explode(F.array(*pieces)).alias("_sm_x"))
    exploded = exploded.filter(F.col("_sm_x").isNotNull() & (F.col("_sm_x.f") < F.col("_sm_x.t")))
    return exploded.select(
        *[F.col(f"`{c}`") for c in body],
        *[F.col(f"_sm_x.a.{o}").alias(o) for o in out_attrs],
        F.col("_sm_x.f").alias("valid_from"),
        F.col("_sm_x.t").alias("valid_to"),
    )


def _ranked_overlaps(L: DataFrame, R: DataFrame, left_key: str, body: list[str]) -> DataFrame:
    """Same rows as ``L LEFT JOIN R ON key AND overlap``, found through positions instead of
    a pairwise residual check."""
    # Keys that are hot over both sides together, asked for once.
    both = R.select(F.col("_sm_rk").alias("_sm_k")).unionByName(L.select(F.col(f"`{left_key}`").alias("_sm_k")))
    hot = hot_keys(both.filter(F.col("_sm_k").isNotNull()), ["_sm_k"])
    R = with_position(R.filter(F.col("_sm_rk").isNotNull()), ["_sm_rk"], ["_sm_rf"], "_sm_i", hot)
    lpay = F.struct(*[F.col(f"`{c}`") for c in body], F.col("_sm_lf"), F.col("_sm_lt"))
    left_t = L.select(lpay.alias("_sm_l"))
    lschema = left_t.schema["_sm_l"].dataType
    rmark = F.struct(F.col("_sm_i").alias("i"), F.col("_sm_rt").alias("rt"))
    rows_r = R.select(F.col("_sm_rk").alias("_sm_k"), F.col("_sm_rf").alias("_sm_t"), rmark.alias("_sm_r"),
                      F.lit(None).cast(lschema).alias("_sm_l"))
    rtype = rows_r.schema["_sm_r"].dataType
    key_of = F.col(f"_sm_l.`{left_key}`")

    # 1) last right version starting at or before l.from  -> first overlapping position
    probe1 = left_t.select(key_of.alias("_sm_k"), F.col("_sm_l._sm_lf").alias("_sm_t"),
                           F.lit(None).cast(rtype).alias("_sm_r"), "_sm_l")
    u1 = rows_r.withColumn("_sm_kind", F.lit(1)).unionByName(probe1.withColumn("_sm_kind", F.lit(2)))
    u1 = u1.withColumn("_sm_tb", F.xxhash64("_sm_l"))
    f1 = with_forward_fill(u1.filter(F.col("_sm_k").isNotNull()), ["_sm_k"], ["_sm_t", "_sm_kind", "_sm_tb"], "_sm_r", "_sm_c1", hot)
    p1 = f1.filter(F.col("_sm_kind") == 2)
    first = F.when(F.col("_sm_c1").isNull(), F.lit(0)).when(F.col("_sm_c1.rt") > F.col("_sm_t"), F.col("_sm_c1.i")).otherwise(F.col("_sm_c1.i") + 1)
    p1 = p1.select("_sm_k", "_sm_l", first.cast("bigint").alias("_sm_lo"))

    # 2) last right version starting strictly before l.to  -> last overlapping position
    probe2 = p1.select("_sm_k", F.col("_sm_l._sm_lt").alias("_sm_t"), F.lit(None).cast(rtype).alias("_sm_r"), "_sm_l", "_sm_lo")
    u2 = rows_r.withColumn("_sm_lo", F.lit(None).cast("bigint")).withColumn("_sm_kind", F.lit(1)).unionByName(
        probe2.withColumn("_sm_kind", F.lit(0)))
    u2 = u2.withColumn("_sm_tb", F.xxhash64("_sm_l"))
    f2 = with_forward_fill(u2, ["_sm_k"], ["_sm_t", "_sm_kind", "_sm_tb"], "_sm_r", "_sm_c2", hot)
    p2 = f2.filter(F.col("_sm_kind") == 0).select("_sm_k", "_sm_l", "_sm_lo", F.col("_sm_c2.i").alias("_sm_hi"))

    # 3) explode the overlapping positions and fetch those versions
    has = F.col("_sm_hi").isNotNull() & (F.col("_sm_lo") <= F.col("_sm_hi"))
    probes = p2.select("_sm_k", "_sm_l", F.explode_outer(F.when(has, F.sequence("_sm_lo", "_sm_hi"))).alias("_sm_pos"))
    nulls = left_t.filter(key_of.isNull()).select(F.lit(None).alias("_sm_k"), "_sm_l", F.lit(None).cast("bigint").alias("_sm_pos"))
    probes = probes.unionByName(nulls.select(F.col("_sm_k").cast(probes.schema["_sm_k"].dataType), "_sm_l", "_sm_pos"))
    joined = probes.join(R, (F.col("_sm_k") == F.col("_sm_rk")) & (F.col("_sm_pos") == F.col("_sm_i")), "left")
    return joined.select("_sm_l.*", *[c for c in R.columns if c != "_sm_i"])


def pit_join(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    at: str,
    attributes: Sequence[str],
    dim_key: str | None = None,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    how: str = "inner",
    strategy: str = "join",
) -> DataFrame:
    """Attach ``attributes`` of the dimension version with ``valid_from <= at < valid_to``.

    ``how="inner"`` drops facts without a version, ``"left"`` keeps them with NULLs.

    * ``strategy="join"``: equi-join on the key with the range as residual.  Cost per key is
      facts x versions, fine when a key has few versions (product dimensions); AQE splits hot fact
      keys and broadcasts the dimension when its measured size allows.
    * ``strategy="asof"``: union facts and versions, order by (key, time) and carry the latest
      version forward (skew-safe forward fill).  O(n log n) whatever the number of versions per key;
      use it for long event histories.
    """
    dk = dim_key or key
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    if strategy == "join":
        D = dim.select(
            F.col(dk).alias("_sm_dk"), F.col(valid_from).alias("_sm_vf"), F.col(valid_to).alias("_sm_vt"), *attributes
        )
        cond = (F.col(key) == F.col("_sm_dk")) & (F.col(at) >= F.col("_sm_vf")) & (F.col(at) < F.col("_sm_vt"))
        return facts.join(D, cond, how).drop("_sm_dk", "_sm_vf", "_sm_vt")
    if strategy != "asof":
        raise ValueError("strategy must be 'join' or 'asof'")

    fact_struct = F.struct(*[F.col(f"`{c}`") for c in facts.columns])
    dim_struct = F.struct(*[F.col(a) for a in attributes], F.col(valid_to).alias("_sm_vt"))
    d = dim.filter(F.col(dk).isNotNull() & F.col(valid_from).isNotNull()).select(
        F.col(dk).alias("_sm_k"), F.col(valid_from).alias("_sm_t"), F.lit(0).alias("_sm_kind"),
        F.lit(0).cast("bigint").alias("_sm_tb"), dim_struct.alias("_sm_dim"),
    )
    f = facts.select(
        F.col(key).alias("_sm_k"), F.col(at).alias("_sm_t"), F.lit(1).alias("_sm_kind"),
        F.xxhash64(fact_struct).alias("_sm_tb"), fact_struct.alias("_sm_fact"),
    )
    d = d.withColumn("_sm_fact", F.lit(None).cast(f.schema["_sm_fact"].dataType))
    f = f.withColumn("_sm_dim", F.lit(None).cast(d.schema["_sm_dim"].dataType))
    u = d.unionByName(f)
    filled = with_forward_fill(u, ["_sm_k"], ["_sm_t", "_sm_kind", "_sm_tb"], "_sm_dim", "_sm_cur")
    rows = filled.filter(F.col("_sm_kind") == 1)
    ok = F.col("_sm_k").isNotNull() & F.col("_sm_t").isNotNull() & F.col("_sm_cur").isNotNull() & (F.col("_sm_t") < F.col("_sm_cur._sm_vt"))
    if how == "inner":
        rows = rows.filter(ok)
    attrs = [F.when(ok, F.col(f"_sm_cur.{a}")).alias(a) for a in attributes]
    return rows.select("_sm_fact.*", *attrs)


def interval_difference(old: DataFrame, new: DataFrame, key: str, value: str, valid_from: str = "valid_from", valid_to: str = "valid_to") -> DataFrame:
    """Where two versions of a history differ: (key, ``valid_from``, ``valid_to``, ``old_value``, ``new_value``)
    for the stretches of time in which they give a key different values; NULL where one has none.

    All bounds of both histories become events, at most one for each key and time, and one ordered pass
    carries both sides' current values (skew-safe forward fills); no join of versions with versions.
    Intervals are half-open and don't overlap within a key and a side; stretches that follow each other
    come out as one row for each pair of bounds.  NULL keys are left out."""

    def bounds(df: DataFrame, side: str) -> DataFrame:
        start = df.select(F.col(key).alias("_sm_k"), F.col(valid_from).alias("_sm_t"), F.col(value).alias("_sm_v"), F.lit(True).alias("_sm_on"))
        end = df.select(F.col(key).alias("_sm_k"), F.col(valid_to).alias("_sm_t"), F.lit(None).cast(df.schema[value].dataType).alias("_sm_v"), F.lit(False).alias("_sm_on"))
        return start.unionByName(end).withColumn("_sm_side", F.lit(side))

    events = bounds(old, "old").unionByName(bounds(new, "new")).filter(F.col("_sm_k").isNotNull())
    # A start at the time of an end wins.
    state = {s: F.max_by(F.struct(F.when(F.col("_sm_on"), F.col("_sm_v")).alias("v")), F.when(F.col("_sm_side") == s, F.col("_sm_on"))).alias(f"_sm_{s}") for s in ("old", "new")}
    at = events.groupBy("_sm_k", "_sm_t").agg(*state.values())
    hot = hot_keys(at, ["_sm_k"])
    at = with_forward_fill(at, ["_sm_k"], ["_sm_t"], "_sm_old", "_sm_old_now", hot=hot)
    at = with_forward_fill(at, ["_sm_k"], ["_sm_t"], "_sm_new", "_sm_new_now", hot=hot)
    at = with_neighbors(at, ["_sm_k"], ["_sm_t"], ["_sm_t"], next="_sm_next", hot=hot)
    before, after = F.col("_sm_old_now.v"), F.col("_sm_new_now.v")
    differ = at.filter(F.col("_sm_next").isNotNull() & ~before.eqNullSafe(after))
    return differ.select(F.col("_sm_k").alias(key), F.col("_sm_t").alias(valid_from), F.col("_sm_next._sm_t").alias(valid_to), before.alias("old_value"), after.alias("new_value"))
