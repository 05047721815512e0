"""Change histories on the events table: a user's activity type and a value band of their
signup/error events, used for ingest, dedupe, SCD-2 and temporal-join queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.history import dedupe_changes, latest_per_key, scd2_from_raw, scd2_merge
from ..operators.scd2_store import Scd2Store
from ..operators.temporal import pit_join, temporal_join
from ..session import materialize, scratch_path
from ..sources import catalog
from ..sources.io import cursor_increment

KEY, TS, TIEBREAK = "user_id", "ts", "event_id"
EVENT_HASH = ["user_id", "event_type"]
STATUS_HASH = ["user_id", "band"]

# Fixed parameters of the registered history queries.
CURSOR_HWM = "2024-01-20 00:00:00"
MERGE_SPLIT = "2024-01-15 00:00:00"
STORE_SPLITS = ("2024-01-10 00:00:00", "2024-01-20 00:00:00")


def _ts(s: str):
    return F.lit(s).cast("timestamp_ntz")


def events_increment(spark: SparkSession, root: str) -> DataFrame:
    return cursor_increment(catalog.events(spark, root), TS, _ts(CURSOR_HWM))


def events_latest(spark: SparkSession, root: str) -> DataFrame:
    return latest_per_key(catalog.events(spark, root), KEY, TS, TIEBREAK)


def events_deduped(spark: SparkSession, root: str) -> DataFrame:
    return dedupe_changes(catalog.events(spark, root), KEY, TS, EVENT_HASH, TIEBREAK)


def events_scd2(spark: SparkSession, root: str) -> DataFrame:
    return scd2_from_raw(catalog.events(spark, root), KEY, TS, EVENT_HASH, TIEBREAK)


def events_scd2_merged(spark: SparkSession, root: str) -> DataFrame:
    ev = catalog.events(spark, root)
    before = ev.filter(F.col(TS) < _ts(MERGE_SPLIT))
    after = ev.filter(F.col(TS) >= _ts(MERGE_SPLIT))
    # The SCD-2 table as stored after the earlier loads (a snapshot table, written once).
    current = materialize(scd2_from_raw(before, KEY, TS, EVENT_HASH, TIEBREAK), "events_scd2_current")
    return scd2_merge(current, after, KEY, TS, EVENT_HASH, TIEBREAK)


def events_scd2_stored(spark: SparkSession, root: str) -> DataFrame:
    """The stored SCD-2 table after a first load, two merges and the second one once more."""
    import uuid

    ev = catalog.events(spark, root)
    store = Scd2Store(spark, scratch_path(spark, f"scd2-{uuid.uuid4().hex[:12]}"), KEY, TS, EVENT_HASH, TIEBREAK)
    cuts = [None, *STORE_SPLITS, None]
    for i, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        part = ev if lo is None else ev.filter(F.col(TS) >= _ts(lo))
        store.merge(part if hi is None else part.filter(F.col(TS) < _ts(hi)), f"batch-{i}")
    store.merge(ev.filter(F.col(TS) >= _ts(STORE_SPLITS[-1])), "the last one again")
    return store.read()


def activity_scd2(spark: SparkSession, root: str) -> DataFrame:
    """Snapshot table of the activity history (written once, like a warehouse snapshot)."""
    h = catalog.activity_history(spark, root)
    return materialize(scd2_from_raw(h, KEY, TS, EVENT_HASH, TIEBREAK), "activity_scd2")


def status_scd2(spark: SparkSession, root: str) -> DataFrame:
    """Snapshot table of the status history."""
    h = catalog.status_history(spark, root)
    return materialize(scd2_from_raw(h, KEY, TS, STATUS_HASH, TIEBREAK), "status_scd2")


def activity_status(spark: SparkSession, root: str, gaps: str, strategy: str = "ranked") -> DataFrame:
    """User activity versions joined through time with status versions.  Event histories can
    have users with very many versions on both sides, so the output-sensitive ranked strategy
    is used instead of the per-key pairwise join."""
    return temporal_join(activity_scd2(spark, root), status_scd2(spark, root), KEY, KEY, ["band"], "status", gaps,
                         strategy=strategy)


def purchases_with_status(spark: SparkSession, root: str, strategy: str = "asof") -> DataFrame:
    purchases = catalog.events(spark, root).filter(F.col("event_type") == "purchase").select("event_id", "ts", "user_id", "value")
    return pit_join(purchases, status_scd2(spark, root), KEY, TS, ["band"], strategy=strategy)
