"""Gates and edit guards: what is checked, whether it holds, and by how much."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from .registry import query


@query("documents", sql="""
SELECT lang AS type, count(*) AS pages, round_even(100.0 * count(*) FILTER (WHERE length(text) >= 400) / count(*), 2) AS coverage,
  count(*) FILTER (WHERE length(text) >= 400) / count(*) >= CASE WHEN lang IS NULL THEN 0.95 ELSE 0.90 END AS ok FROM documents GROUP BY ROLLUP (lang)""")  # fmt: skip
def coverage_gate(documents: DataFrame) -> DataFrame:
    """95 % of all texts and 90 % of each type must be long enough."""
    good = F.count_if(F.length("text") >= 400)
    out = documents.rollup(F.col("lang").alias("type")).agg(F.count("*").alias("pages"), F.bround(100.0 * good / F.count("*"), 2).alias("coverage"), (good / F.count("*")).alias("share"))
    return out.select("type", "pages", "coverage", (F.col("share") >= F.when(F.col("type").isNull(), 0.95).otherwise(0.90)).alias("ok"))


@query("conversations", sql=r"""
WITH p AS (SELECT a.conv_id, a.turn, a.text AS a, b.text AS b FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1),
m AS (SELECT *, len(list_filter(string_split(regexp_replace(a, '\s+', ' ', 'g'), ' '), lambda w: w <> '')) AS wa, len(list_filter(string_split(regexp_replace(b, '\s+', ' ', 'g'), ' '), lambda w: w <> '')) AS wb,
  list_sort(list_distinct(list_transform(regexp_extract_all(a, '(\d[\d,.]*\d)', 1), lambda x: regexp_replace(x, ',', '', 'g')))) AS na, list_sort(list_distinct(list_transform(regexp_extract_all(b, '(\d[\d,.]*\d)', 1), lambda x: regexp_replace(x, ',', '', 'g')))) AS nb FROM p)
SELECT conv_id, turn, abs(wb - wa) <= greatest(8, 0.05 * wa) AS words_ok, na = nb AS numbers_ok, len(list_filter(nb, lambda x: NOT list_contains(na, x))) AS invented FROM m""")  # fmt: skip
def edit_guards(conversations: DataFrame) -> DataFrame:
    """Whether an edit keeps the number of words within 8 or 5 %, and the same numbers; and how many it makes up."""
    after = conversations.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("b"))
    both = conversations.withColumnRenamed("text", "a").join(after, ["conv_id", "turn"])
    wa, wb, na, nb = X.word_count(F.col("a")), X.word_count(F.col("b")), X.numbers(F.col("a")), X.numbers(F.col("b"))
    return both.select("conv_id", "turn", (F.abs(wb - wa) <= F.greatest(F.lit(8.0), 0.05 * wa)).alias("words_ok"), (F.array_sort(na) == F.array_sort(nb)).alias("numbers_ok"), F.size(F.array_except(nb, na)).cast("long").alias("invented"))


@query("pages", sql="""
SELECT page_id, regexp_matches(lower(right(html, 4096)), '</html>') AS closed, strlen(html) AS bytes FROM pages""")  # fmt: skip
def truncation_gate(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", F.contains(F.lower(F.right("html", F.lit(4096))), F.lit("</html>")).alias("closed"), F.octet_length("html").cast("long").alias("bytes"))


@query("lineitem", sql="""
SELECT l_suppkey AS competitor, count(*) AS pages, count(*) FILTER (WHERE l_quantity > 20 AND l_discount > 0.04) AS heavy, count(*) FILTER (WHERE l_returnflag = 'N') < 40 AS low_keep FROM lineitem GROUP BY 1""")  # fmt: skip
def keep_alarm(lineitem: DataFrame) -> DataFrame:
    return lineitem.groupBy(F.col("l_suppkey").alias("competitor")).agg(F.count("*").alias("pages"), F.count_if((F.col("l_quantity") > 20) & (F.col("l_discount") > 0.04)).alias("heavy"), (F.count_if(F.col("l_returnflag") == "N") < 40).alias("low_keep"))


@query("documents", "labels", sql="""
WITH t AS (SELECT 'labels known' AS item, count(*) FILTER (WHERE d.doc_id IS NOT NULL) AS reached, count(*) AS wanted FROM labels l LEFT JOIN documents d ON d.doc_id = l.doc_id
  UNION ALL SELECT 'texts labelled', count(*) FILTER (WHERE l.doc_id IS NOT NULL), count(*) FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id) SELECT item, reached, wanted, reached >= 0.8 * wanted AS ok FROM t""")  # fmt: skip
def completeness(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each check, ticked by what was counted."""

    def check(item: str, want: DataFrame, got: DataFrame) -> DataFrame:
        flagged = want.select("doc_id").join(got.select("doc_id").distinct().withColumn("hit", F.lit(1)), "doc_id", "left")
        return flagged.agg(F.count("hit").alias("reached"), F.count("*").alias("wanted")).select(F.lit(item).alias("item"), "reached", "wanted", (F.col("reached") >= 0.8 * F.col("wanted")).alias("ok"))

    return check("labels known", labels, documents).union(check("texts labelled", documents, labels))
