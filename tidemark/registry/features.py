"""Point-in-time features, neighbours by cosine, text chunks, streams joined in time, sessions, and append-only reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import passages, personal, pointintime, similarity, snapshots
from tidemark.plans.tables import SCHEMAS, Tables
from tidemark.registry.core import query
from tidemark.registry.streams import halves, land
from tidemark.session import work_path
from tidemark.sources import incremental
from tidemark.streaming import appends, runs, sinks, transforms


@query("feature_as_of", """
SELECT p.event_id, p.user_id, p.ts, arg_max(v.value, (v.ts, v.value, v.event_id)) AS last_view_value,
       arg_max(v.event_id, (v.ts, v.value, v.event_id)) AS last_view_id
FROM events p LEFT JOIN events v ON v.event_type = 'view' AND v.user_id = p.user_id AND v.ts <= p.ts
  AND v.value IS NOT NULL
WHERE p.event_type = 'purchase' GROUP BY p.event_id, p.user_id, p.ts""")
def feature_as_of(t: Tables) -> DataFrame:
    views = t.events.filter("event_type = 'view' AND value IS NOT NULL").select(
        "user_id", "ts", F.col("value").alias("last_view_value"), F.col("event_id").alias("last_view_id"))
    bought = t.events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    return pointintime.as_of_join(bought, views, ["user_id"], "ts", "ts", ["last_view_value", "last_view_id"])


@query("fresh_feature_as_of", """
SELECT event_id, user_id, CASE WHEN seen >= ts - INTERVAL 6 HOURS THEN value END AS fresh_view_value FROM (
  SELECT p.event_id, p.user_id, p.ts, max(v.ts) AS seen, arg_max(v.value, (v.ts, v.value)) AS value
  FROM events p LEFT JOIN events v ON v.event_type = 'view' AND v.user_id = p.user_id AND v.ts <= p.ts
    AND v.value IS NOT NULL
  WHERE p.event_type = 'purchase' GROUP BY p.event_id, p.user_id, p.ts)""")
def fresh_feature_as_of(t: Tables) -> DataFrame:
    views = t.events.filter("event_type = 'view' AND value IS NOT NULL").select(
        "user_id", "ts", F.col("value").alias("fresh_view_value"))
    bought = t.events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    return pointintime.as_of_join(bought, views, ["user_id"], "ts", "ts", ["fresh_view_value"], within="6 hours").select(
        "event_id", "user_id", "fresh_view_value")


@query("cosine_neighbours", f"""
WITH v AS (SELECT vec_id AS id, list_transform(embedding, lambda c: floor(c::DOUBLE * {similarity.SCALE})) AS x FROM embeddings
  WHERE embedding IS NOT NULL),
n AS (SELECT id, x, list_inner_product(x, x) AS norm FROM v WHERE list_inner_product(x, x) > 0)
SELECT query_id, rank::INTEGER AS rank, id, similarity FROM (
  SELECT query_id, id, similarity, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, id) AS rank FROM (
    SELECT q.id AS query_id, n.id AS id, list_inner_product(q.x, n.x) / sqrt(q.norm * n.norm) AS similarity
    FROM n q JOIN n ON q.id <> n.id WHERE q.id % 100 = 0)) WHERE rank <= 10""")
def cosine_neighbours(t: Tables) -> DataFrame:
    vectors = t.embeddings
    return similarity.nearest(vectors, vectors.filter("vec_id % 100 = 0"), 10, "vec_id", "embedding")


@query("document_chunks", """
SELECT doc_id, chunk::INTEGER AS chunk, (chunk * 800)::INTEGER AS start, least(chunk * 800 + 1000, length(text))::INTEGER AS "end",
       substring(text, chunk * 800 + 1, 1000) AS chunk_text
FROM (SELECT doc_id, text, unnest(generate_series(0, greatest(ceil((length(text) - 1000) / 800)::BIGINT, 0))) AS chunk
      FROM documents WHERE text IS NOT NULL)""")
def document_chunks(t: Tables) -> DataFrame:
    return passages.chunks(t.documents, ["doc_id"])


GAPS = """
SELECT session_start, max(ts) + INTERVAL 30 MINUTES AS session_end, user_id, count(*) AS events,
       CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / 100 AS total_value FROM (
  SELECT *, max(CASE WHEN opens THEN ts END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session_start FROM (
    SELECT *, coalesce(ts > lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 30 MINUTES, true) AS opens
    FROM events)) GROUP BY session_start, user_id"""


def sessions_of(events: DataFrame, delay: str | None = None) -> DataFrame:
    total = F.sum(F.round(F.col("value") * 100).cast("bigint")).cast("double") / 100
    return transforms.sessions(transforms.event_time(events), "ts", "30 minutes", ["user_id"], delay,
                               events=F.count(F.lit(1)), total_value=total)


@query("user_sessions", GAPS)
def user_sessions(t: Tables) -> DataFrame:
    return sessions_of(t.events)


@query("stream_sessions", GAPS)
def stream_sessions(t: Tables) -> DataFrame:
    """The sessions of a stream that comes in two parts; the second brings the first day's rows that came late."""
    root = work_path(t.spark, "sessions")
    early, late = halves(t)
    held = (F.col("event_id") % 50 == 0) & (F.col("ts") < F.lit("2024-01-02").cast("timestamp_ntz"))
    for part in (early.filter(~held), late.unionByName(early.filter(held))):
        land(part, f"{root}/source")
        stream = incremental.table_stream(t.spark, f"{root}/source", SCHEMAS["events"])
        sinks.complete_sink(sessions_of(stream, "40 days"), f"{root}/table", f"{root}/checkpoint")
    return snapshots.read_as_of(t.spark, f"{root}/table")


@query("stream_join_in_time", f"""
WITH kept AS (SELECT * FROM events WHERE NOT (event_id % 50 = 0 AND ts < TIMESTAMP '2024-01-02'))
SELECT p.event_id AS purchase_id, v.event_id AS view_id, user_id, p.ts AS bought_at, v.ts AS viewed_at
FROM kept p JOIN kept v USING (user_id)
WHERE p.event_type = 'purchase' AND v.event_type = 'view' AND v.ts <= p.ts AND v.ts >= p.ts - INTERVAL 12 HOURS""")
def stream_join_in_time(t: Tables) -> DataFrame:
    """Purchases with the views of the twelve hours before, over two streams that come in two parts. Pairs across the
    border come from the state; rows that come days later than the watermark are dropped on both sides."""
    root = work_path(t.spark, "joined")
    early, late = halves(t)
    held = (F.col("event_id") % 50 == 0) & (F.col("ts") < F.lit("2024-01-02").cast("timestamp_ntz"))
    for part in (early.filter(~held), late.unionByName(early.filter(held))):
        sides = []
        for kind, id_, time in (("purchase", "purchase_id", "bought_at"), ("view", "view_id", "viewed_at")):
            land(part.filter(F.col("event_type") == kind), f"{root}/{kind}")
            stream = incremental.table_stream(t.spark, f"{root}/{kind}", SCHEMAS["events"])
            sides.append(transforms.event_time(stream).select(
                "user_id", F.col("event_id").alias(id_), F.col("ts").alias(time)))
        found = transforms.join_in_time(*sides, ["user_id"], "bought_at", "viewed_at", "12 hours", "1 hour").select(
            "purchase_id", "view_id", "user_id", F.col("bought_at").cast("timestamp_ntz").alias("bought_at"),
            F.col("viewed_at").cast("timestamp_ntz").alias("viewed_at"))
        runs.run_available(found, f"{root}/table", f"{root}/checkpoint")
    return t.spark.read.schema(found.schema).parquet(f"{root}/table")


@query("stream_skips_rewrites", "SELECT event_id, user_id, value FROM events")
def stream_skips_rewrites(t: Tables) -> DataFrame:
    """A reader that follows an append, a rewrite of all values and another append sees each appended row once, as it was
    appended."""
    root = work_path(t.spark, "followed")
    table, target, checkpoint = f"{root}/table", f"{root}/target", f"{root}/checkpoint"
    early, late = (part.select("event_id", "user_id", "value") for part in halves(t))
    snapshots.append(early, table)
    appends.follow(t.spark, table, target, checkpoint)
    doubled = snapshots.read_as_of(t.spark, table).withColumn("value", F.col("value") * 2)
    snapshots.commit(doubled, table, "UPDATE")
    snapshots.append(late, table)
    appends.follow(t.spark, table, target, checkpoint)
    return t.spark.read.schema(early.schema).parquet(target).select(early.columns)


@query("personal_data_counts", """
WITH c AS (
  SELECT doc_id, 'card' AS rule, unnest(regexp_extract_all(text, '[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{4}|[0-9]{8,}')) AS value FROM documents
  UNION ALL SELECT doc_id, 'iban', unnest(regexp_extract_all(text, '[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}')) FROM documents
  UNION ALL SELECT doc_id, 'ipv4', unnest(regexp_extract_all(text, '[0-9]{1,3}(?:[.][0-9]{1,3}){3}')) FROM documents),
d AS (SELECT *, regexp_replace(value, '[ -]', '', 'g') AS digits, value[5:] || value[1:4] AS moved, string_split(value, '.') AS parts FROM c),
v AS (SELECT doc_id, rule, CASE rule
  WHEN 'card' THEN length(digits) BETWEEN 13 AND 19 AND list_sum(list_transform(generate_series(1, length(digits)), lambda i:
    CASE WHEN (length(digits) - i) % 2 = 0 THEN digits[i]::INT WHEN digits[i]::INT > 4 THEN 2 * digits[i]::INT - 9
    ELSE 2 * digits[i]::INT END)) % 10 = 0
  WHEN 'iban' THEN list_reduce(list_transform(generate_series(1, length(moved)), lambda i:
    CASE WHEN moved[i] <= '9' THEN ascii(moved[i]) - 48 ELSE ascii(moved[i]) - 55 END::BIGINT),
    lambda a, n: (a * CASE WHEN n > 9 THEN 100 ELSE 10 END + n) % 97) = 1
  ELSE len(list_filter(parts, lambda p: p::INT <= 255 AND (length(p) = 1 OR p[1] <> '0'))) = 4 END AS valid FROM d)
SELECT rule, count(*) AS candidates, count(*) FILTER (WHERE valid) AS valid, count(DISTINCT doc_id) FILTER (WHERE valid) AS documents
FROM v GROUP BY rule""")
def personal_data_counts(t: Tables) -> DataFrame:
    return personal.counts(t.documents, "doc_id")
