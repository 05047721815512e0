"""Data-quality checks (O-22, O-23, O-30, O-47 .. O-52).  Every check returns the failing rows;
an empty result means the check passed.  :func:`run_suite` evaluates many checks and returns one
row per check with its failure count."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sequence import with_neighbor


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows where ``column`` is NULL."""
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their count (``n_records``).  Rows with a NULL
    in the key are not checked.  A partial aggregate: a hot key costs one row per task."""
    cols = [columns] if isinstance(columns, str) else list(columns)
    non_null = F.lit(True)
    for c in cols:
        non_null = non_null & F.col(c).isNotNull()
    return df.filter(non_null).groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1)


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child values (one row per child row) with no parent row; NULL children pass."""
    c = child.filter(F.col(column).isNotNull()).select(F.col(column).alias("from_field"))
    p = parent.select(F.col(field).alias("to_field")).distinct()
    return c.join(p, F.col("from_field") == F.col("to_field"), "left_anti")


def accepted_range(
    df: DataFrame, column: str, min_value=None, max_value=None, inclusive: bool = True
) -> DataFrame:
    """Values outside [min_value, max_value] (or the open interval when not inclusive); NULL passes."""
    c = F.col(column)
    ok = F.lit(True)
    if min_value is not None:
        ok = ok & ((c >= F.lit(min_value)) if inclusive else (c > F.lit(min_value)))
    if max_value is not None:
        ok = ok & ((c <= F.lit(max_value)) if inclusive else (c < F.lit(max_value)))
    return df.select(c.alias(column)).filter(~ok)


def scd_time_range(
    history: DataFrame,
    snapshot: DataFrame,
    on: Sequence[tuple[str, str]],
    history_from: str = "valid_from",
    history_to: str = "valid_to",
    snapshot_from: str = "valid_from",
    snapshot_to: str = "valid_to",
) -> DataFrame:
    """Segments of a temporally joined history whose attributes came from ``snapshot`` but whose
    interval is not inside any snapshot version with the same values (``on`` = pairs of
    (history column, snapshot column)).  Segments without attributes (NULL) are not checked."""
    s = snapshot.select(*[F.col(sc).alias(f"_sm_s{i}") for i, (_, sc) in enumerate(on)],
                        F.col(snapshot_from).alias("_sm_sf"), F.col(snapshot_to).alias("_sm_st"))
    cond = (F.col("_sm_sf") <= F.col(history_from)) & (F.col("_sm_st") >= F.col(history_to))
    has_attrs = F.lit(True)
    for i, (hc, _) in enumerate(on):
        cond = cond & (F.col(hc) == F.col(f"_sm_s{i}"))
        has_attrs = has_attrs & F.col(hc).isNotNull()
    return history.filter(has_attrs).join(s, cond, "left_anti")


def scd_overlaps(df: DataFrame, key: str, valid_from: str = "valid_from", valid_to: str = "valid_to") -> DataFrame:
    """Versions whose successor (same key, next valid_from) starts before they end: overlapping
    SCD-2 versions.  One ordered neighbour pass, no pairwise self-join."""
    nb = with_neighbor(df, [key], [valid_from, valid_to], [valid_from], "_sm_next", "next")
    return nb.filter(F.col(f"_sm_next.{valid_from}") < F.col(valid_to)).drop("_sm_next")


@dataclass
class CheckSpec:
    """One configured check.  ``kind`` is not_null | unique | relationships | accepted_range | scd_time_range."""

    name: str
    table: str
    kind: str
    column: str | Sequence[str]
    tags: tuple[str, ...] = ()
    args: dict = field(default_factory=dict)


#: Checks that look at one row by itself.
LOCAL_KINDS = ("not_null", "accepted_range")


def fails(spec: CheckSpec) -> Column:
    """Whether a row fails a row-local check."""
    c = F.col(spec.column)
    if spec.kind == "not_null":
        return c.isNull()
    lo, hi, inc = spec.args.get("min_value"), spec.args.get("max_value"), spec.args.get("inclusive", True)
    ok = F.lit(True)
    if lo is not None:
        ok = ok & ((c >= F.lit(lo)) if inc else (c > F.lit(lo)))
    if hi is not None:
        ok = ok & ((c <= F.lit(hi)) if inc else (c < F.lit(hi)))
    return F.coalesce(~ok, F.lit(False))


def evaluate(spec: CheckSpec, tables: dict[str, DataFrame]) -> DataFrame:
    df = tables[spec.table]
    if spec.kind == "not_null":
        return not_null(df, spec.column)
    if spec.kind == "unique":
        return unique(df, spec.column)
    if spec.kind == "relationships":
        return relationships(df, spec.column, tables[spec.args["to"]], spec.args["field"])
    if spec.kind == "accepted_range":
        return accepted_range(df, spec.column, spec.args.get("min_value"), spec.args.get("max_value"),
                              spec.args.get("inclusive", True))
    if spec.kind == "scd_time_range":
        return scd_time_range(df, tables[spec.args["to"]], spec.args["on"])
    raise ValueError(f"unknown check kind {spec.kind}")


def select_checks(specs: Sequence[CheckSpec], tags: Sequence[str] | None = None) -> list[CheckSpec]:
    """Checks carrying any of ``tags`` (all checks when ``tags`` is None)."""
    if tags is None:
        return list(specs)
    wanted = set(tags)
    return [s for s in specs if wanted & set(s.tags)]


def _failures(spec: CheckSpec, tables: dict[str, DataFrame]) -> DataFrame:
    """One row ``n_failed``.  Children are counted per key (map-side) before they meet their parents."""
    if spec.kind != "relationships":
        return evaluate(spec, tables).agg(F.count(F.lit(1)).alias("n_failed"))
    per_key = tables[spec.table].groupBy(F.col(spec.column).alias("_sm_child")).agg(F.count(F.lit(1)).alias("_sm_n"))
    parents = tables[spec.args["to"]].select(F.col(spec.args["field"]).alias("_sm_parent")).distinct()
    orphans = per_key.filter(F.col("_sm_child").isNotNull()).join(parents, F.col("_sm_child") == F.col("_sm_parent"), "left_anti")
    return orphans.agg(F.coalesce(F.sum("_sm_n"), F.lit(0)).alias("n_failed"))


def run_suite(specs: Sequence[CheckSpec], tables: dict[str, DataFrame]) -> DataFrame:
    """One row per check: (check_name, table_name, kind, n_failed).

    Row-local checks (not_null, accepted_range) of one table are folded into a single scan with one
    ``count_if`` per check; grouping and join checks run as their own aggregate.  Everything is
    unioned lazily: one Spark job computes the whole summary."""
    parts: list[DataFrame] = []
    local: dict[str, list[CheckSpec]] = {}
    for s in specs:
        if s.kind in LOCAL_KINDS:
            local.setdefault(s.table, []).append(s)
        else:
            parts.append(_failures(s, tables).select(
                F.lit(s.name).alias("check_name"), F.lit(s.table).alias("table_name"), F.lit(s.kind).alias("kind"),
                F.col("n_failed").cast("bigint").alias("n_failed")))
    for table, group in local.items():
        df = tables[table]
        aggs = []
        for i, s in enumerate(group):
            aggs.append(F.count_if(fails(s)).alias(f"_sm_c{i}"))
        row = df.agg(*aggs)
        stacked = F.explode(F.array(*[
            F.struct(F.lit(s.name).alias("check_name"), F.lit(s.table).alias("table_name"), F.lit(s.kind).alias("kind"),
                     F.col(f"_sm_c{i}").cast("bigint").alias("n_failed"))
            for i, s in enumerate(group)
        ]))
        parts.append(row.select(stacked.alias("_sm_r")).select("_sm_r.*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
