"""Supports in trailing windows for many as-of dates in one pass (O-45).

An order has one date, so the counts of a window are the sum of its days' counts.  The bounds of all
windows cut the time line into stretches; each row adds to the count of its stretch, and the count of
a window is a difference of two running sums over the stretches.  One aggregate with a column per
stretch, which combines before its exchange, serves all dates: the input is read once however many
dates there are, and no row is joined with dates or repeated for them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .baskets import BASKET, ITEM, SCOPE, parse_date_key, scoped_items, with_scope_figures
from .rules import CELL_ITEMS, pair_rows


def _key(day: dt.date) -> int:
    return int(day.strftime("%Y%m%d"))


def window_bounds(as_of: Sequence[int], window: int | None) -> list[tuple[int | None, int]]:
    """Per as-of date the date keys [from, to) of its window: strictly before the date and, with
    ``window``, strictly after ``window`` days earlier, as :func:`baskets.scope_filter` has it."""
    ends = [parse_date_key(d) for d in as_of]
    return [(None if window is None else _key(e - dt.timedelta(days=int(window) - 1)), _key(e)) for e in ends]


def as_of_counts(rows: DataFrame, keys: Sequence[str], date_key: str, as_of: Sequence[int], window: int | None = None, out: str = "n") -> DataFrame:
    """``keys``, ``as_of`` and the number of rows whose ``date_key`` lies in that date's window, where there are any."""
    bounds = window_bounds(as_of, window)
    cuts = sorted({b for pair in bounds for b in pair if b is not None})
    day = F.col(date_key)
    stretches = [day < cuts[0], *[(day >= a) & (day < b) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]]
    per = rows.groupBy(*keys).agg(*[F.count(F.when(s, F.lit(1))).alias(f"_sm_{i}") for i, s in enumerate(stretches)])
    # running[i]: rows before cuts[i]
    running = F.array(*[sum((F.col(f"_sm_{j}") for j in range(1, i + 1)), F.col("_sm_0")) for i in range(len(cuts))])
    per = per.select(*keys, running.alias("_sm_run"))
    at = {c: i for i, c in enumerate(cuts)}
    each = [F.struct(F.lit(d).cast("bigint").alias("as_of"), (F.col("_sm_run")[at[to]] - (F.lit(0) if start is None else F.col("_sm_run")[at[start]])).alias(out))
            for d, (start, to) in zip(as_of, bounds, strict=True)]
    return per.select(*keys, F.explode(F.array(*each)).alias("_sm_w")).select(*keys, "_sm_w.*").filter(F.col(out) > 0)


def as_of_supports(lines: DataFrame, basket: str, item: str, as_of: Sequence[int], window: int | None = None, territory: str | None = "TerritoryID",
                   date_key: str = "OrderDateKey", cell_items: int = CELL_ITEMS) -> DataFrame:
    """(scope, as_of, a, b, n, n_baskets, support) of all items (``b`` is null) and pairs a < b, per scope and as-of date.

    Rows outside all windows are left out where the lines are read.  Each basket has one date."""
    bounds = window_bounds(as_of, window)
    starts = [s for s, _ in bounds if s is not None]
    inside = F.col(date_key) < max(e for _, e in bounds)
    if len(starts) == len(bounds):
        inside = inside & (F.col(date_key) >= min(starts))
    dated = lines.filter(inside & F.col(basket).isNotNull()).withColumn("_sm_dated", F.struct(F.col(date_key).alias("day"), F.col(basket).alias("id")))
    items = scoped_items(dated, "_sm_dated", item, territory)
    baskets = items.select(SCOPE, BASKET).distinct().withColumn("day", F.col("basket.day"))
    n = as_of_counts(baskets, [SCOPE], "day", as_of, window, "n_baskets").groupBy(SCOPE).agg(F.map_from_entries(F.collect_list(F.struct("as_of", "n_baskets"))).alias("_sm_n"))
    single = as_of_counts(items.withColumn("day", F.col("basket.day")), [SCOPE, ITEM], "day", as_of, window)
    single = single.select(SCOPE, "as_of", F.col(ITEM).alias("a"), F.lit(None).cast(items.schema[ITEM].dataType).alias("b"), "n")
    pairs = as_of_counts(pair_rows(items, cell_items).withColumn("day", F.col("basket.day")), [SCOPE, "a", "b"], "day", as_of, window)
    both = with_scope_figures(single.unionByName(pairs.select(SCOPE, "as_of", "a", "b", "n")), n)
    n_baskets = F.col("_sm_n")[F.col("as_of")]
    return both.select(SCOPE, "as_of", "a", "b", "n", n_baskets.alias("n_baskets"), (F.col("n") / n_baskets).alias("support"))
