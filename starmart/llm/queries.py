"""The queries of the numbered operators; each applies one to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, centroids, decontaminate, jaccard_join, line_dedup, quality_classifier, quality_rules, sharding, spelling, suffix_dedup, toxicity, url_filter, warc
from .tables import fold, read_table

SHARDS = 24
#: Score from which a classifier's verdict is 1.
CONFIDENT = 0.7

#: Fixed rules of the URL query.
HOST_RULES = [
    url_filter.HostRule("allow", "com", "/"),
    url_filter.HostRule("block", "example.com", "/en/"),
    url_filter.HostRule("allow", "www.example.com", "/en/"),
    url_filter.HostRule("block", "net", "/es/"),
    url_filter.HostRule("block", "net", "/fr/"),
]
#: Glob rules for URLs that no host rule fits: junk hosts, numbered list pages, archives and log-ins.
GLOB_RULES = [
    url_filter.GlobRule("block", "**ads-track.*/**"),
    url_filter.GlobRule("block", "**casino-win.*/**"),
    url_filter.GlobRule("block", "**cheap-pills.*/**"),
    url_filter.GlobRule("block", "**free-bets.*/**"),
    url_filter.GlobRule("block", "**spam-farm.*/**"),
    url_filter.GlobRule("block", "**adult-x.*/**"),
    url_filter.GlobRule("block", "*/**\\?page=[23456789]*"),
    url_filter.GlobRule("block", "*/**/login*"),
    url_filter.GlobRule("block", "*/**.zip"),
    url_filter.GlobRule("allow", "docs.*/**\\?page=[23456789]*"),
]


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), fold("doc_id", 3) != 1)
    return scored.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= CONFIDENT).cast("int").alias("predicted"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    keys = {"doc_id": F.col("doc_id"), "size": (F.octet_length(text) + 8).cast("bigint"), "text_crc32": F.crc32(text)}
    return sharding.assign_shards(docs, keys, SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.delete_blocks(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> quality_classifier.QualityModel:
    """Learns from the rows that are not held out only."""
    return quality_classifier.train(docs, read_table(spark, sf_dir, "labels"), fold("doc_id", 4) != 2)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    scored = quality_classifier.score(docs, quality_model(spark, docs, sf_dir))
    return scored.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= CONFIDENT).cast("int").alias("predicted"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontaminate.find_items(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return hits.select("doc_id", "item_id", "n_item_shingles", "n_shared")


OP5_SQL = """
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), i AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM benchmark
), ds AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k+4], ' '))
                                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM d
), items AS (
  SELECT DISTINCT item_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k+4], ' '))
                                       WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM i
), n AS (SELECT item_id, count(*) AS n_item_shingles FROM items GROUP BY item_id),
hits AS (SELECT ds.doc_id, items.item_id, count(*) AS n_shared FROM ds JOIN items ON ds.s = items.s GROUP BY ds.doc_id, items.item_id)
SELECT hits.doc_id, hits.item_id, n.n_item_shingles, hits.n_shared
FROM hits JOIN n ON n.item_id = hits.item_id WHERE 100 * hits.n_shared >= 80 * n.n_item_shingles
"""


def captures(pages: DataFrame) -> DataFrame:
    """A crawl history of the pages, derived from them: per page one full response and two revisits, one
    with an ETag and one with Last-Modified; some before the response, some with other validators."""
    p = pages.select("page_id", "url", F.md5("html").alias("digest"), F.octet_length("html").alias("n"), F.expr("timestamp_ntz'2024-01-01 00:00:00'").alias("start"))

    def at(seconds: str) -> str:
        return f"timestampadd(SECOND, {seconds}, start)"

    def date(seconds: str) -> str:
        return f"date_format({at(seconds)}, 'EEE, dd MMM yyyy HH:mm:ss') || ' GMT'"

    first, other = "page_id * 7919 % 2592000", "page_id * 104729 % 2592000"
    kinds = [
        ("R", "response", first, f"""'HTTP/1.1 200 OK\r\nDate: ' || {date(first)} || '\r\nETag: "' || left(digest, 12) || '"\r\nLast-Modified: '
            || {date("page_id % 1000")} || '\r\nContent-Type: text/html\r\nContent-Length: ' || n || '\r\nCache-Control: max-age=60'"""),
        ("E", "revisit", other, f"""'HTTP/1.1 304 Not Modified\r\nDate: ' || {date(other)} || '\r\nETag: W/"'
            || CASE WHEN page_id % 5 = 0 THEN 'other' ELSE left(digest, 12) END || '"\r\nCache-Control: max-age=120\r\nContent-Length: 0'"""),
        ("M", "revisit", f"{first} + 3600", f"""'HTTP/1.1 304 Not Modified\r\nDate: ' || {date(f"{first} + 3600")} || '\r\nLast-Modified: '
            || {date("page_id % 1000 + CASE WHEN page_id % 6 = 0 THEN 60 ELSE 0 END")} || '\r\nX-Cache: hit'"""),
    ]
    each = [f"struct('{kind}-' || page_id AS record_id, '{type_}' AS warc_type, {at(when)} AS warc_date, {block} AS http_block)" for kind, type_, when, block in kinds]
    wide = p.select("url", "digest", F.explode(F.expr(f"array({', '.join(each)})")).alias("x"))
    return wide.select("x.*", F.col("url").alias("target_uri"), F.when(F.col("x.warc_type") == "response", F.col("digest")).alias("payload_digest"))


def op6_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved = warc.resolve_revisits(captures(read_table(spark, sf_dir, "pages")))
    names = {"date": "date", "etag": "etag", "last-modified": "last_modified", "content-length": "content_length", "cache-control": "cache_control", "x-cache": "x_cache"}
    return resolved.select("record_id", "canonical_uri", "outcome", "resolved_id", *[F.try_element_at("headers", F.lit(k)).alias(v) for k, v in names.items()])


OP6_SQL = """
WITH rest AS (
  SELECT page_id, left(md5(html), 12) AS tag, strlen(html) AS n,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT *, regexp_replace(regexp_replace(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '^www\\.', ''), ':(80|443)$', '') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
         array_to_string(list_filter(string_split(regexp_extract(rest, '^[^?#]*\\?([^#]*)', 1), '&'), lambda p: NOT starts_with(p, 'utm_') AND p <> ''), '&') AS query
  FROM rest
), p AS (
  SELECT page_id, tag, n, CASE WHEN host <> '' THEN host || CASE WHEN path = '' THEN '/' ELSE path END || CASE WHEN query <> '' THEN '?' || query ELSE '' END END AS canonical_uri,
         page_id * 7919 % 2592000 AS first, page_id * 104729 % 2592000 AS other FROM parts
), r AS (
  SELECT 'R-' || page_id AS record_id, canonical_uri, first AS sec, true AS is_full, '"' || tag || '"' AS etag, page_id % 1000 AS modified, CAST(n AS VARCHAR) AS content_length, 'max-age=60' AS cache_control, CAST(NULL AS VARCHAR) AS x_cache FROM p
  UNION ALL
  SELECT 'E-' || page_id, canonical_uri, other, false, 'W/"' || CASE WHEN page_id % 5 = 0 THEN 'other' ELSE tag END || '"', NULL, '0', 'max-age=120', NULL FROM p
  UNION ALL
  SELECT 'M-' || page_id, canonical_uri, first + 3600, false, NULL, page_id % 1000 + CASE WHEN page_id % 6 = 0 THEN 60 ELSE 0 END, NULL, NULL, 'hit' FROM p
), placed AS (
  SELECT *, last_value(CASE WHEN is_full THEN record_id END IGNORE NULLS) OVER (PARTITION BY canonical_uri ORDER BY sec, record_id) AS earlier FROM r
), judged AS (
  SELECT x.*, e.etag AS e_etag, e.modified AS e_modified, e.content_length AS e_length, e.cache_control AS e_cache,
         CASE WHEN x.is_full THEN 'response' WHEN x.canonical_uri IS NULL OR x.earlier IS NULL THEN 'no_earlier'
              WHEN x.etag IS NOT NULL THEN CASE WHEN replace(x.etag, 'W/', '') = e.etag THEN 'resolved' ELSE 'mismatch' END
              ELSE CASE WHEN x.modified = e.modified THEN 'resolved' ELSE 'mismatch' END END AS outcome
  FROM placed x LEFT JOIN r e ON e.record_id = x.earlier
), merged AS (
  SELECT record_id, canonical_uri, outcome, CASE outcome WHEN 'response' THEN record_id WHEN 'resolved' THEN earlier END AS resolved_id, sec,
         CASE WHEN outcome = 'resolved' THEN coalesce(etag, e_etag) ELSE etag END AS etag,
         CASE WHEN outcome = 'resolved' THEN coalesce(modified, e_modified) ELSE modified END AS modified,
         CASE WHEN outcome = 'resolved' THEN e_length ELSE content_length END AS content_length,
         CASE WHEN outcome = 'resolved' THEN coalesce(cache_control, e_cache) ELSE cache_control END AS cache_control,
         CASE WHEN outcome = 'resolved' THEN NULL ELSE x_cache END AS x_cache
  FROM judged
)
SELECT record_id, canonical_uri, outcome, resolved_id, strftime(TIMESTAMP '2024-01-01' + to_seconds(sec), '%a, %d %b %Y %H:%M:%S GMT') AS date, etag,
       strftime(TIMESTAMP '2024-01-01' + to_seconds(modified), '%a, %d %b %Y %H:%M:%S GMT') AS last_modified, content_length, cache_control, x_cache
FROM merged
"""


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.components(read_table(spark, sf_dir, "documents"))


OP7_SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k+4], ' '))
                                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM d
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)
), both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM d
  UNION
  SELECT reach.a, l.b FROM reach JOIN both_ways l ON l.a = reach.b
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(reach.b) AS component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id JOIN reach ON reach.a = d.doc_id GROUP BY ALL
"""


def bpe_digests() -> list:
    """Digest columns of ``ids`` and ``decoded``."""
    return [
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    ]


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    ids = bpe.encode(read_table(spark, sf_dir, "documents"), ranks, pattern)
    both = bpe.decode(ids, ranks, pattern, keep=("doc_id", "ids"))
    return both.select("doc_id", *bpe_digests())


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(read_table(spark, sf_dir, "documents"))
    failed = quality_rules.base_failed()
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & (F.col("posterior") >= 0.5)).alias("kept"))


def _op9_sql() -> str:
    """Counts, votes and the label model's steps, one CTE each, over the vote patterns."""
    q, rules = quality_rules, quality_rules.RULES
    sep, k = "[\\x20\\x09-\\x0D]", range(len(quality_rules.RULES))

    def without(chars: str) -> str:
        return f"length(t) - length(translate(t, '{chars.replace(chr(39), chr(39) * 2)}', ''))"

    marked = f"translate(x, '{q.SYMBOLS}', '') <> x"
    votes = ", ".join(f"CASE WHEN {r.bad.format(x=f'({r.ratio})')} THEN -1 WHEN {r.good.format(x=f'({r.ratio})')} THEN 1 ELSE 0 END AS v{j}" for j, r in enumerate(rules))
    ctes = [f"""t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '{sep}+'), lambda x: x <> '') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_replace(x, '{sep}', '', 'g') <> '') AS ls FROM t),
windows AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(w[i:i+4], ' ')) AS c
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5)),
starts AS (SELECT doc_id, i, coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), i - 5) AS before FROM windows WHERE c > 1),
repeats AS (SELECT doc_id, sum(least(5, i - before)) AS n FROM starts GROUP BY doc_id),
counts AS (SELECT w.doc_id, len(w) AS n_words, length(regexp_replace(t, '{sep}', '', 'g')) AS word_chars, {without(q.SYMBOLS)} AS n_symbols,
                  len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words,
                  len(list_filter(w, lambda x: {marked})) AS n_marked_words, len(list_filter(ls, lambda x: {marked})) AS n_marked_lines,
                  {without(q.MARKS)} AS n_marks, {without(q.UPPER)} AS n_upper, {without("!")} AS n_shouts, {without(q.DIGITS)} AS n_digits,
                  len(list_distinct(w)) AS n_distinct_words
           FROM w LEFT JOIN repeats r ON r.doc_id = w.doc_id),
voted AS MATERIALIZED (SELECT *, {votes} FROM counts),
patterns AS MATERIALIZED (SELECT {", ".join(f"v{j}" for j in k)}, CAST(count(*) AS DOUBLE) AS n FROM voted GROUP BY ALL)"""]
    start = ", ".join(f"{q.START_GOOD[0]}::DOUBLE AS gn{j}, {q.START_GOOD[1]}::DOUBLE AS gp{j}, {q.START_BAD[0]}::DOUBLE AS bn{j}, {q.START_BAD[1]}::DOUBLE AS bp{j}" for j in k)
    ctes.append(f"m0 AS MATERIALIZED (SELECT 0.5::DOUBLE AS share, {start})")
    odds = " + ".join(f"CASE v{j} WHEN -1 THEN least(0, ln(gn{j} / bn{j})) WHEN 1 THEN greatest(0, ln(gp{j} / bp{j})) ELSE 0 END" for j in k)
    posterior = f"1 / (1 + exp(-(ln(share / (1 - share)) + {odds})))"
    sums = ", ".join(f"coalesce(sum(CASE WHEN v{j} = {v} THEN n END), 0) AS a{c}{j}, coalesce(sum(CASE WHEN v{j} = {v} THEN n * p END), 0) AS g{c}{j}" for j in k for v, c in ((-1, "n"), (1, "p")))
    weight = q.START_WEIGHT
    rates = ", ".join(
        f"(g{c}{j} + {weight * q.START_GOOD[i]}) / (g + {weight}) AS g{c}{j}, (greatest(0, a{c}{j} - g{c}{j}) + {weight * q.START_BAD[i]}) / (n - g + {weight}) AS b{c}{j}"
        for j in k for i, c in enumerate("np"))
    for step in range(q.STEPS):
        ctes.append(f"s{step} AS MATERIALIZED (SELECT sum(n) AS n, sum(n * p) AS g, {sums} FROM (SELECT patterns.*, {posterior} AS p FROM patterns, m{step}))")
        ctes.append(f"m{step + 1} AS MATERIALIZED (SELECT (g + 1) / (n + 2) AS share, {rates} FROM s{step})")
    failed = "(n_words < 10 OR 100 * n_repeat_words > 20 * n_words)"
    return "WITH " + ",\n".join(ctes) + f"""
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {failed} AS base_failed,
       (NOT {failed} AND {posterior} >= 0.5) AS kept FROM voted, m{q.STEPS}"""


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(read_table(spark, sf_dir, "pages"), HOST_RULES, GLOB_RULES, keep=("page_id",))


OP10_SQL = """
WITH rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^?#]*\\?([^#]*)', 1) AS query
  FROM rest
), kept AS (
  SELECT page_id, host, path,
         array_to_string(list_filter(string_split(query, '&'), lambda p: NOT starts_with(p, 'utm_') AND p <> ''), '&') AS query
  FROM parts
), canon AS (
  SELECT page_id, host, path, host || path || CASE WHEN query <> '' THEN '?' || query ELSE '' END AS canonical_url FROM kept
), rules(verdict, host, path) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
         ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), fits AS (
  SELECT c.page_id, max_by(r.host || r.path, length(r.host || r.path)) AS rule, max_by(r.verdict, length(r.host || r.path)) AS verdict
  FROM canon c JOIN rules r ON (c.host = r.host OR ends_with(c.host, '.' || r.host)) AND starts_with(c.path, r.path)
  GROUP BY c.page_id
), globs(no, verdict, glob_rule, pattern, len) AS (
  VALUES (0, 'block', '**ads-track.*/**', '^.*ads-track\\.[^/]*/.*$', 11), (1, 'block', '**casino-win.*/**', '^.*casino-win\\.[^/]*/.*$', 12),
         (2, 'block', '**cheap-pills.*/**', '^.*cheap-pills\\.[^/]*/.*$', 13), (3, 'block', '**free-bets.*/**', '^.*free-bets\\.[^/]*/.*$', 11),
         (4, 'block', '**spam-farm.*/**', '^.*spam-farm\\.[^/]*/.*$', 11), (5, 'block', '**adult-x.*/**', '^.*adult-x\\.[^/]*/.*$', 9),
         (6, 'block', '*/**\\?page=[23456789]*', '^[^/]*/.*\\?page=[23456789][^/]*$', 7), (7, 'block', '*/**/login*', '^[^/]*/.*/login[^/]*$', 7),
         (8, 'block', '*/**.zip', '^[^/]*/.*\\.zip$', 5),
         (9, 'allow', 'docs.*/**\\?page=[23456789]*', '^docs\\.[^/]*/.*\\?page=[23456789][^/]*$', 12)
), hits AS (
  SELECT c.page_id, g.glob_rule, g.verdict,
         row_number() OVER (PARTITION BY c.page_id ORDER BY g.len DESC, g.verdict DESC, g.no) AS nr
  FROM canon c JOIN globs g ON regexp_matches(c.canonical_url, g.pattern, 's')
)
SELECT c.page_id, c.host, c.path, c.canonical_url, f.rule, h.glob_rule, coalesce(f.verdict, h.verdict, 'allow') AS verdict
FROM canon c LEFT JOIN fits f ON f.page_id = c.page_id LEFT JOIN hits h ON h.page_id = c.page_id AND h.nr = 1
"""

def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read_table(spark, sf_dir, "documents"), every=97, min_length=5, min_count=3, factor=2)


#: crc32 by a table of 256 entries over the UTF-8 bytes; near words meet on what is left without one letter.
OP11_SQL = """
WITH RECURSIVE bits AS (
  SELECT b, 0 AS k, b AS c FROM range(256) t(b)
  UNION ALL
  SELECT b, k + 1, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END FROM bits WHERE k < 8
), crc AS (SELECT list(c ORDER BY b) AS t FROM bits WHERE k = 8),
runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents)
  GROUP BY ALL
), bytes AS (
  SELECT run, n, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
         lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [192 + unicode(c) // 64, 128 + unicode(c) % 64] END)) AS bs FROM runs
), hashed AS (
  SELECT run, n, xor(list_reduce(bs, lambda s, b: xor(crc.t[(xor(s, b) & 255) + 1], s // 256), 4294967295), 4294967295) AS h FROM bytes, crc
), words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) AS INTEGER) + 2) ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), cut AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), one_way AS (
  SELECT a.word AS a, b.word AS b FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT cut.word, words.word FROM cut JOIN words ON words.word = cut.rest
), near AS (SELECT a, b FROM one_way UNION SELECT b, a FROM one_way),
best AS (
  SELECT near.a AS word, count(*) AS n_near, min(struct_pack(less := -words.n, other := near.b)) AS x FROM near JOIN words ON words.word = near.b GROUP BY near.a
), forms AS (
  SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN -x.less >= 2 * words.n THEN x.other END AS form, CASE WHEN -x.less >= 2 * words.n THEN -x.less END AS form_n
  FROM words LEFT JOIN best ON best.word = words.word
), chain AS (
  SELECT word, word AS at FROM forms
  UNION ALL
  SELECT chain.word, forms.form FROM chain JOIN forms ON forms.word = chain.at WHERE forms.form IS NOT NULL
)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, chain.at AS root FROM forms f JOIN chain ON chain.word = f.word JOIN forms e ON e.word = chain.at AND e.form IS NULL
"""


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    figures = [F.col("n_bytes"), F.aggregate("spans", F.lit(0).cast("bigint"), lambda s, x: s + x["to"] - x["from"]).alias("n_removed"),
               F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")]
    return suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"), length=200, result=figures)


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.with_inertia(*centroids.cluster(read_table(spark, sf_dir, "embeddings"), dim=64, k=8, rounds=10, scale=1024, seed="3"))


def _op13_sql(k: int = 8, rounds: int = 10) -> str:
    """Each round a CTE of assignments and one of centroids; floor division of sums that may be negative."""
    ctes = ["""v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
            f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, q) - 1 AS k, q FROM (SELECT q, sha256('3:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h FROM v) ORDER BY h, q LIMIT {k})"]
    for t in range(rounds + 1):
        ctes.append(f"""a{t} AS MATERIALIZED (SELECT vec_id, q, min(struct_pack(d := d, k := k)) AS best FROM (
  SELECT n, vec_id, v.q, c.k, CAST(list_sum(list_transform(range(1, 65), lambda i: (v.q[i] - c.q[i]) * (v.q[i] - c.q[i]))) AS BIGINT) AS d
  FROM (SELECT *, row_number() OVER () AS n FROM v) v, c{t} c) GROUP BY n, vec_id, q)""")
        if t < rounds:
            ctes.append(f"""c{t + 1} AS MATERIALIZED (SELECT c.k, coalesce(m.q, c.q) AS q FROM c{t} c LEFT JOIN (
  SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY i) AS q FROM (
    SELECT best.k AS k, i, sum(q[i]) AS s, count(*) AS n FROM (SELECT best, q, unnest(range(1, 65)) AS i FROM a{t}) GROUP BY ALL) GROUP BY k) m ON m.k = c.k)""")
    return "WITH " + ",\n".join(ctes) + f"""
SELECT vec_id, CAST(best.k AS INTEGER) AS cluster, best.d AS distance, CAST(sum(best.d) OVER (PARTITION BY best.k) AS BIGINT) AS cluster_inertia,
       CAST(sum(best.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.q, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} c ON c.k = best.k"""


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_sharding": op2_sharding,
    "op3_line_dedup": op3_line_dedup,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_decontamination": op5_decontamination,
    "op6_warc_revisits": op6_warc_revisits,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_quality_rules": op9_quality_rules,
    "op10_url_filter": op10_url_filter,
    "op11_spelling": op11_spelling,
    "op12_suffix_dedup": op12_suffix_dedup,
    "op13_centroids": op13_centroids,
}
ORACLE = {
    "op5_decontamination": OP5_SQL,
    "op6_warc_revisits": OP6_SQL,
    "op7_jaccard_join": OP7_SQL,
    "op9_quality_rules": _op9_sql(),
    "op10_url_filter": OP10_SQL,
    "op11_spelling": OP11_SQL,
    "op13_centroids": _op13_sql(),
}
