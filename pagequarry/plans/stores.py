"""Paths of a content-addressed store, rows inside cells, and what a frontier of work takes in."""

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.vector_store import VectorStore
from ..session import shared_dir
from ..sources.keyed import KeyedTable
from ..sources.tables import blob_path, sub_rows
from ..streaming.frontier import replay
from .registry import query


@query("pages", sql="""
SELECT page_id, substr(sha256(html), 1, 2) || '/' || sha256(html) || '.' || CASE page_id % 5 WHEN 0 THEN 'html' WHEN 1 THEN 'json' WHEN 2 THEN 'pdf' WHEN 3 THEN 'xml' ELSE 'bin' END AS path FROM pages""")  # fmt: skip
def blob_paths(pages: DataFrame) -> DataFrame:
    """Where each page is stored, by its content and the type that came with it."""
    kinds = F.array(*map(F.lit, ["text/HTML; charset=utf-8", "application/json", "application/pdf", "text/xml", "image/png"]))
    return pages.select("page_id", blob_path(F.col("html"), F.get(kinds, F.col("page_id") % 5)).alias("path"))


@query("part", sql="""
WITH s AS (SELECT p_partkey, unnest(string_split(replace(p_name, ' ', ' ; ') || ' ;  ; ' || p_type, ';')) AS part, generate_subscripts(string_split(replace(p_name, ' ', ' ; ') || ' ;  ; ' || p_type, ';'), 1) AS pos FROM part)
SELECT p_partkey, count(*) AS parts, string_agg(trim(part), ' + ' ORDER BY pos) AS joined FROM s WHERE trim(part) <> '' GROUP BY 1""")  # fmt: skip
def cells_rejoined(part: DataFrame) -> DataFrame:
    """Cells split into rows at semicolons, blank ones out, and joined again."""
    cells = part.select("p_partkey", F.concat(F.replace("p_name", F.lit(" "), F.lit(" ; ")), F.lit(" ;  ; "), "p_type").alias("cell"))
    listed = F.array_sort(F.collect_list(F.struct("part_pos", "part")))
    return sub_rows(cells, "cell", ";").groupBy("p_partkey").agg(F.count("*").alias("parts"), F.array_join(F.transform(listed, lambda p: p["part"]), " + ").alias("joined"))


def admitted(frontier: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """The frontier (key, state) and, as pending, each key found that it lacks, once; null keys are left out."""
    new = found.select(key).where(F.col(key).isNotNull()).distinct().join(frontier.select(key), key, "left_anti")
    return frontier.select(key, "state").unionByName(new.withColumn("state", F.lit("pending")))


@query("orders", "lineitem", sql="""
WITH f AS (SELECT o_orderkey AS k, CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'in_progress' ELSE 'failed' END AS state FROM orders WHERE o_totalprice > 50000),
a AS (SELECT * FROM f UNION ALL SELECT k, 'pending' FROM (SELECT DISTINCT l_orderkey AS k FROM lineitem) WHERE k NOT IN (SELECT k FROM f)) SELECT state, count(*) AS n, min(k) AS first FROM a GROUP BY 1""")  # fmt: skip
def frontier_counts(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """How many keys of a frontier are in each state once those found are let in."""
    state = F.when(F.col("o_orderstatus") == "F", "done").when(F.col("o_orderstatus") == "O", "in_progress").otherwise("failed")
    frontier = orders.where("o_totalprice > 50000").select(F.col("o_orderkey").alias("k"), state.alias("state"))
    return admitted(frontier, lineitem.select(F.col("l_orderkey").alias("k")), "k").groupBy("state").agg(F.count("*").alias("n"), F.min("k").alias("first"))


def _path(df: DataFrame, name: str) -> str:
    return f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"


@query("events", sql="""
WITH l AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id % 3 DESC, ts DESC, event_id DESC) AS rn FROM events)
SELECT user_id || '/' || event_type AS url, value, event_id FROM l WHERE rn = 1""")  # fmt: skip
def upserted_values(events: DataFrame) -> DataFrame:
    """A table on disk after three runs that put rows in by key: a later run replaces what an earlier one put, within a run the latest row holds."""
    table = KeyedTable(events.sparkSession, _path(events, "values"), "url", "url string, value double, event_id long, ts timestamp", 16)
    rows = events.select(F.concat_ws("/", "user_id", "event_type").alias("url"), "value", "event_id", "ts")
    for run in range(3):
        table.put(rows.where(F.col("event_id") % 3 == run), F.struct("ts", "event_id"))
    return table.rows().drop("ts")


@query("documents", sql="""
WITH h AS (SELECT sha256(lower(coalesce(source, '') || text)) AS sha, doc_id, doc_id % 2 AS run FROM documents WHERE text IS NOT NULL), f AS (SELECT sha, min(run) AS run FROM h GROUP BY 1)
SELECT sha, run, max(doc_id) AS made_for FROM h JOIN f USING (sha, run) GROUP BY 1, 2""")  # fmt: skip
def cached_by_content(documents: DataFrame) -> DataFrame:
    """What a cache keyed by the hash of contents holds after two runs: the second works only on contents that the first lacked."""
    cache = KeyedTable(documents.sparkSession, _path(documents, "cache"), "sha", "sha string, run long, made_for long", 16)
    hashed = documents.where("text is not null").select(F.sha2(F.lower(F.concat(F.coalesce("source", F.lit("")), "text")), 256).alias("sha"), (F.col("doc_id") % 2).alias("run"), F.col("doc_id").alias("made_for"))
    for run in range(2):
        cache.put(hashed.where(F.col("run") == run), F.col("made_for"), keep_old=True)
    return cache.rows()


@query("embeddings")
def store_neighbours(embeddings: DataFrame) -> DataFrame:
    """The ten nearest of every vector, from a store that was made of three quarters of the rows and had the others put in. A test measures recall."""
    store = VectorStore.made(embeddings.where("vec_id % 4 != 0"), _path(embeddings, "vectors"))
    store.put(embeddings.where("vec_id % 4 = 0"))
    return store.search(embeddings).select("query_id", F.col("id").alias("vec_id"), F.round("sim", 4).alias("sim"), "rn")


_DEEDS = "CASE event_type WHEN 'view' THEN 'add' WHEN 'purchase' THEN 'done' WHEN 'error' THEN 'fail' ELSE 'claim' END"
_FREE = "e.event = 'claim' AND (r.state = 'pending' OR r.state = 'in_progress' AND r.claimed < e.at - 900)"


@query("events", sql=f"""
WITH RECURSIVE e AS (SELECT user_id::VARCHAR AS url, epoch(ts) AS at, {_DEEDS} AS event, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
r AS (SELECT url, rn, CASE WHEN event = 'add' THEN 'pending' END AS state, CASE WHEN event = 'add' THEN 0 END AS attempts, NULL::DOUBLE AS claimed, (event = 'add')::INT AS took FROM e WHERE rn = 1
UNION ALL SELECT e.url, e.rn, CASE WHEN e.event = 'add' THEN coalesce(r.state, 'pending') WHEN r.state IS NULL THEN NULL WHEN {_FREE} THEN 'in_progress' WHEN e.event = 'done' THEN 'done' WHEN e.event = 'fail' THEN 'failed' ELSE r.state END,
  CASE WHEN e.event = 'add' AND r.state IS NULL THEN 0 WHEN {_FREE} THEN r.attempts + 1 ELSE r.attempts END, CASE WHEN {_FREE} THEN e.at ELSE r.claimed END,
  r.took + CASE WHEN e.event = 'add' THEN (r.state IS NULL)::INT WHEN r.state IS NULL THEN 0 WHEN e.event = 'claim' THEN coalesce({_FREE}, FALSE)::INT ELSE 1 END FROM r JOIN e ON e.url = r.url AND e.rn = r.rn + 1)
SELECT url, arg_max(state, rn) AS state, arg_max(attempts, rn) AS attempts, max(took)::BIGINT AS took FROM r GROUP BY 1""")  # fmt: skip
def claimed_frontier(events: DataFrame) -> DataFrame:
    """What a frontier of work holds of each URL after all that was asked of it, run as a stream with keyed state; and how many of its events took effect."""
    spark, folder = events.sparkSession, _path(events, "frontier")
    deed = F.when(F.col("event_type") == "view", "add").when(F.col("event_type") == "purchase", "done").when(F.col("event_type") == "error", "fail").otherwise("claim")
    rows = events.select(F.col("user_id").cast("string").alias("url"), F.col("ts").cast("timestamp").alias("at"), F.col("event_id").alias("seq"), deed.alias("event"))
    rows.write.parquet(f"{folder}/in")
    told = replay(spark, f"{folder}/in", "url string, at timestamp, seq long, event string", f"{folder}/out", f"{folder}/checkpoint", files=0).where("seq is not null")
    last = F.struct("at", "seq")
    return told.groupBy("url").agg(F.max_by("state", last).alias("state"), F.max_by("attempts", last).alias("attempts"), F.count_if("granted").alias("took"))
