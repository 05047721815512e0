"""WARC: not-modified revisits resolved against the latest earlier full response of the same URL.

A crawl stores a full response once and, while the server answers "304 Not Modified", short revisit
records without a body.  Here each revisit is joined as of its time to the latest earlier response
(status 200) of its canonical URL, its validators are compared with that response's, and the two
header blocks are merged: fields that a 304 may renew (:data:`RENEWED`) come from the revisit, all
others from the stored response.

The as-of join is a forward fill over (canonical URL, date, record id): one ordered pass, no pairs.
The helper splits URLs with very many records, so a URL with a third of all captures is spread over
tasks.  Bodies take no part in it; :func:`with_bodies` joins them to the resolved records by id.

Columns of records: ``record_id``, ``warc_type`` ('response' or 'revisit'), ``target_uri``,
``warc_date`` (timestamp), ``http_block`` (status line and header lines), ``payload_digest``; others
are ignored.

Outcomes: ``response`` (a full response stands for itself), ``resolved``, ``mismatch`` (the validators
differ), ``no_validator`` (nothing to compare), ``no_earlier`` (no earlier full response), ``other``
(any other record, among them responses that are not 200).

Validators: the revisit's ETag if it has one (weak comparison, ``W/`` does not count), else its
Last-Modified, else its payload digest; what it has must equal the response's.

Edge cases: records without URL, date or id resolve nothing and are never resolved; equal dates are
ordered by record id; repeated records are resolved alike; a header given twice counts as given
last, a line without a colon is skipped; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.sequence import with_forward_fill
from .url_filter import url_parts

#: Fields that a not-modified answer may renew.
RENEWED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")


def canonical_uri(url: Column) -> Column:
    """Host without ``www.`` and default port, path (at least ``/``), query without ``utm_`` parameters; no scheme, no fragment."""
    host, path, query = url_parts(url)
    host = F.regexp_replace(F.regexp_replace(host, r"^www\.", ""), r":(80|443)$", "")
    kept = F.array_join(F.filter(F.split(query, "&"), lambda p: ~p.startswith("utm_") & (p != "")), "&")
    whole = F.concat(host, F.when(path == "", F.lit("/")).otherwise(path), F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(F.lit("")))
    return F.when(host != "", whole)


def status(block: Column) -> Column:
    return F.regexp_extract(block, r"^HTTP/[0-9.]+ ([0-9]{3})", 1).try_cast("int")


def headers(block: Column) -> Column:
    """Map of the header lines, names in lower case; the last of a name counts."""
    lines = F.filter(F.split(block, "\r?\n"), lambda x: F.instr(x, ":") > 1)
    pairs = F.transform(lines, lambda x: F.struct(F.lower(F.trim(F.substring_index(x, ":", 1))).alias("k"), F.trim(x.substr(F.instr(x, ":") + 1, F.length(x))).alias("v")))

    def last_of_each(ps: Column) -> Column:
        names = F.transform(ps, lambda p: p.k)
        return F.filter(ps, lambda p, i: ~F.array_contains(F.slice(names, i + 2, F.size(ps)), p.k))

    # The pairs are bound once (an array of one array), so the lambdas don't split the block again for each line.
    return F.map_from_entries(F.get(F.transform(F.array(pairs), last_of_each), F.lit(0)))


def resolve_revisits(records: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """record_id, canonical_uri, outcome, resolved_id (of the response that has the body), headers (merged where resolved)."""
    r = records.select(
        "record_id", "warc_type", "warc_date", "payload_digest", canonical_uri(F.col("target_uri")).alias("canonical_uri"),
        status(F.col("http_block")).alias("status"), headers(F.coalesce("http_block", F.lit(""))).alias("headers"))
    full = (F.col("warc_type") == "response") & (F.col("status") == 200)
    usable = F.col("record_id").isNotNull() & F.col("canonical_uri").isNotNull() & F.col("warc_date").isNotNull()
    r = r.withColumn("full", F.coalesce(full, F.lit(False))).withColumn("usable", usable)
    r = r.withColumn("stored", F.when(F.col("full") & F.col("usable"), F.struct("record_id", "payload_digest", "headers")))
    placed = with_forward_fill(r.filter("usable"), ["canonical_uri"], ["warc_date", "record_id"], "stored", "earlier", hot_rows=hot_rows)
    rest = r.filter("NOT usable").withColumn("earlier", F.lit(None).cast(r.schema["stored"].dataType))
    j = placed.unionByName(rest)

    def field(of: str, name: str) -> Column:
        return F.try_element_at(F.col(of), F.lit(name))

    def etag(of: str) -> Column:
        return F.regexp_replace(field(of, "etag"), "^W/", "")

    own = F.coalesce(etag("headers"), field("headers", "last-modified"), F.col("payload_digest"))
    theirs = (F.when(etag("headers").isNotNull(), etag("earlier.headers")).when(field("headers", "last-modified").isNotNull(), field("earlier.headers", "last-modified"))
              .otherwise(F.col("earlier.payload_digest")))
    outcome = (F.when(F.col("full"), F.lit("response")).when(F.coalesce(F.col("warc_type") != "revisit", F.lit(True)), F.lit("other"))
               .when(F.col("earlier").isNull(), F.lit("no_earlier")).when(own.isNull(), F.lit("no_validator"))
               .when(own.eqNullSafe(theirs), F.lit("resolved")).otherwise(F.lit("mismatch")))
    j = j.withColumn("outcome", outcome)
    renewed = F.map_filter("headers", lambda k, _: k.isin(*RENEWED))
    kept = F.map_filter(F.col("earlier.headers"), lambda k, _: ~F.coalesce(F.array_contains(F.map_keys(renewed), k), F.lit(False)))
    merged = F.when(F.col("outcome") == "resolved", F.map_concat(kept, renewed)).otherwise(F.col("headers"))
    return j.select(
        "record_id", "canonical_uri", "outcome",
        F.when(F.col("outcome") == "response", F.col("record_id")).when(F.col("outcome") == "resolved", F.col("earlier.record_id")).alias("resolved_id"),
        merged.alias("headers"))


def with_bodies(resolved: DataFrame, records: DataFrame, body_col: str = "body") -> DataFrame:
    """``resolved`` with the body of the response that each record resolves to; ids of responses must be unique."""
    bodies = records.filter(F.col("warc_type") == "response").select(F.col("record_id").alias("body_id"), F.col(body_col).alias("body"))
    return resolved.join(bodies, F.col("resolved_id") == F.col("body_id"), "left").drop("body_id")
