"""Tables written in a format and read back, runs that resume, stages that are kept, and reports."""

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.similarity import blended_top_k
from ..session import shared_dir
from ..sources.tables import csv, json_rows, write_csv
from ..sources.xlsx import books_of, rows_of
from ..streaming.queue import resume, snapshot
from .registry import query


def _folder(df: DataFrame) -> str:
    return f"{shared_dir(df.sparkSession)}/formats-{uuid.uuid4().hex}"


def _delimited(documents: DataFrame, sep: str) -> DataFrame:
    path, names = _folder(documents), ["text", "doc_id", "absent", "source"]
    write_csv(documents, path, names, sep)
    back = csv(documents.sparkSession, path, "doc_id long, source string, text string, absent string", sep)
    return back.select("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("md5"), F.coalesce("source", F.lit("")).alias("source"), F.coalesce("absent", F.lit("")).alias("absent"))


_DELIMITED = "SELECT doc_id, md5(coalesce(text, '')) AS md5, coalesce(source, '') AS source, '' AS absent FROM documents"


@query("documents", sql=_DELIMITED)
def csv_round_trip(documents: DataFrame) -> DataFrame:
    """Texts of many lines through comma-separated cells: columns in another order, one that is absent, others left out."""
    return _delimited(documents, ",")


@query("documents", sql=_DELIMITED)
def tsv_round_trip(documents: DataFrame) -> DataFrame:
    """The same through cells that tabs separate."""
    return _delimited(documents, "\t")


@query("conversations", sql="SELECT conv_id, max(turn) AS turn, count(*) AS n, md5(string_agg(coalesce(text, ''), '|' ORDER BY turn)) AS md5 FROM conversations GROUP BY 1")
def json_log(conversations: DataFrame) -> DataFrame:
    """A log of JSON lines that was added to in two runs, read whole; a log that isn't there is empty."""
    path = _folder(conversations)
    for k in range(2):
        conversations.where(F.col("turn") % 2 == k).write.mode("append").json(path)
    schema = "conv_id long, turn long, text string"
    log = json_rows(conversations.sparkSession, path, schema).union(json_rows(conversations.sparkSession, f"{path}-absent", schema))
    texts = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", F.coalesce("text", F.lit("")).alias("t")))), lambda x: x["t"]), "|")
    return log.groupBy("conv_id").agg(F.max("turn").alias("turn"), F.count("*").alias("n"), F.md5(texts).alias("md5"))


@query("part", sql="SELECT p_brand || '.xlsx' AS name, p_type AS sheet, p_partkey AS row, '<&>\" ' || p_name AS first, NULL AS second, p_size::VARCHAR AS third FROM part")
def workbook_rows(part: DataFrame) -> DataFrame:
    """Rows through workbooks, one for each brand, with a sheet for each type: cells of any characters, and an absent one between two others."""
    cells = F.array(F.concat(F.lit('<&>" '), "p_name"), F.lit(None).cast("string"), F.col("p_size").cast("string"))
    rows = part.select(F.concat("p_brand", F.lit(".xlsx")).alias("name"), F.col("p_type").alias("sheet"), F.col("p_partkey").alias("row"), cells.alias("cells"))
    cell = lambda k: F.get("cells", F.lit(k))
    return rows_of(books_of(rows), "name").select("name", "sheet", "row", cell(0).alias("first"), cell(1).alias("second"), cell(2).alias("third"))


@query("documents", sql="SELECT doc_id, length(text) AS chars FROM documents WHERE text IS NOT NULL")
def resumed_rows(documents: DataFrame) -> DataFrame:
    """What three runs wrote of files that kept coming: each run works only on those that no earlier one has, and the last finds nothing."""
    spark, path = documents.sparkSession, _folder(documents)
    rows = documents.select("doc_id", "text")
    for k in range(3):
        if k < 2:
            rows.where(F.col("doc_id") % 2 == k).write.mode("append").parquet(f"{path}/in")
        resume(spark, f"{path}/in", "doc_id long, text string", f"{path}/out", f"{path}/marks", lambda df: df.where("text is not null").select("doc_id", F.length("text").alias("chars")))
    return spark.read.schema("doc_id long, chars int").parquet(f"{path}/out")


@query("orders", sql="SELECT o_orderpriority AS stage, count(*) AS n, 1 AS made FROM orders GROUP BY 1")
def stage_snapshot(orders: DataFrame) -> DataFrame:
    """A stage that a job made once and a later run took as it was, though it would make it otherwise now."""
    spark, path = orders.sparkSession, _folder(orders)
    made = lambda k: orders.groupBy(F.col("o_orderpriority").alias("stage")).agg(F.count("*").alias("n"), F.lit(k).alias("made"))
    for k in (1, 2):
        kept = snapshot(spark, path, "counted", lambda k=k: made(k))
    return kept


def markdown_table(rows: DataFrame, key: str, columns: list[str], order: list[str]) -> DataFrame:
    """(key, report): the rows of each key as a table of text, bars and line breaks in cells spelled out."""
    flat = lambda c: F.regexp_replace(F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("|"), F.lit("\\|")), r"\s*\n\s*", " ")
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *[flat(c) for c in columns]), F.lit(" |"))
    lines = F.transform(F.array_sort(F.collect_list(F.struct(*order, line.alias("_line")))), lambda x: x["_line"])
    head = F.lit(f"| {' | '.join(columns)} |\n|{'---|' * len(columns)}\n")
    return rows.groupBy(key).agg(F.concat(head, F.array_join(lines, "\n")).alias("report"))


def html_list(rows: DataFrame, key: str, title: str, text: str, order: list[str]) -> DataFrame:
    """(key, page): the rows of each key as a page of headings and paragraphs, with what HTML reserves spelled out."""
    safe = lambda c: F.replace(F.replace(F.replace(F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), F.lit('"'), F.lit("&quot;"))
    item = F.concat(F.lit("<h2>"), safe(title), F.lit("</h2>\n<p>"), safe(text), F.lit("</p>"))
    items = F.transform(F.array_sort(F.collect_list(F.struct(*order, item.alias("_item")))), lambda x: x["_item"])
    return rows.groupBy(key).agg(F.concat(F.lit("<!doctype html>\n<html><body>\n"), F.array_join(items, "\n"), F.lit("\n</body></html>")).alias("page"))


@query("lineitem", sql=r"""
WITH t AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS place FROM lineitem)
SELECT l_suppkey, '| place | l_orderkey | l_returnflag |' || chr(10) || '|---|---|---|' || chr(10) || string_agg('| ' || place || ' | ' || l_orderkey || ' | ' || l_returnflag || '\| |', chr(10) ORDER BY place) AS report FROM t WHERE place <= 5 GROUP BY 1""")  # fmt: skip
def markdown_reports(lineitem: DataFrame) -> DataFrame:
    """The five dearest lines of each supplier as a table of text."""
    w = Window.partitionBy("l_suppkey").orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber")
    top = lineitem.withColumn("place", F.row_number().over(w)).where("place <= 5").withColumn("l_returnflag", F.concat("l_returnflag", F.lit("|")))
    return markdown_table(top, "l_suppkey", ["place", "l_orderkey", "l_returnflag"], ["place"])


@query("conversations", sql="""
SELECT conv_id, md5('<!doctype html>' || chr(10) || '<html><body>' || chr(10) || string_agg('<h2>' || role || '</h2>' || chr(10) || '<p>' || replace(replace(replace(replace('<b>"' || coalesce(text, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;') || '</p>', chr(10) ORDER BY turn) || chr(10) || '</body></html>') AS page FROM conversations GROUP BY 1""")  # fmt: skip
def html_reports(conversations: DataFrame) -> DataFrame:
    """Each conversation as a page of HTML; a hash of it."""
    said = conversations.withColumn("text", F.concat(F.lit('<b>"'), F.coalesce("text", F.lit(""))))
    return html_list(said, "conv_id", "role", "text", ["turn"]).select("conv_id", F.md5("page").alias("page"))


@query("embeddings", sql="""
WITH u AS (SELECT vec_id, label, vec_id // 5 AS page, vec_id % 5 = 0 AS title, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings), n AS (SELECT *, sqrt(list_dot_product(v, v)) AS l FROM u),
s AS (SELECT q.vec_id AS query_id, r.page, r.title, r.label, list_dot_product(q.v, r.v) / (q.l * r.l) AS sim FROM n q JOIN n r ON q.vec_id % 20 = 0),
b AS (SELECT query_id, page, max(sim) FILTER (WHERE title) AS own, coalesce(max(sim) FILTER (WHERE NOT title), -1) AS body, bool_or(title AND label = 3) AS away FROM s GROUP BY 1, 2),
r AS (SELECT query_id, page, round(0.5 * own + 0.5 * body, 6) AS score FROM b WHERE own IS NOT NULL AND NOT away)
SELECT query_id, page, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, page) AS rn FROM r QUALIFY rn <= 40""")  # fmt: skip
def blended_pages(embeddings: DataFrame) -> DataFrame:
    """The forty pages nearest to each asking vector: half the title's likeness, half that of the best of all its chunks; pages of one language are left out."""
    pages = embeddings.select(F.floor(F.col("vec_id") / 5).alias("page"), (F.col("vec_id") % 5 == 0).alias("title"), "label", "embedding")
    away = pages.where("title and label = 3").select("page").distinct()
    near = blended_top_k(embeddings.where("vec_id % 20 = 0"), pages.join(away, "page", "left_anti"), 40, "vec_id", "page", "title", "embedding")
    return near.select("query_id", "page", "score", "rn")
