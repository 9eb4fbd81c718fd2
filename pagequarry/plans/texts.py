"""Chunks, sentences, numbers, phrases, tags and clean-up of texts."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.diff import word_edits
from .registry import query

_SENT = r"list_filter(list_transform(string_split(regexp_replace(text, '([.!?])\s+', '\1␞', 'g'), '␞'), lambda s: trim(regexp_replace(s, '\s+', ' ', 'g'))), lambda s: s <> '')"
_WORDS = r"list_filter(string_split(regexp_replace({}, '\s+', ' ', 'g'), ' '), lambda w: w <> '')"


@query("documents", sql="""
SELECT doc_id, k AS start, length(substr(text, k + 1, 4800)) AS n, sha256(substr(text, k + 1, 4800)) AS sha
FROM (SELECT doc_id, text, unnest(range(0, CAST(ceil(greatest(length(text) - 4800, 0) / 4200.0) AS BIGINT) * 4200 + 1, 4200)) AS k FROM documents)""")  # fmt: skip
def chunks(documents: DataFrame) -> DataFrame:
    cut = documents.select("doc_id", "text", F.explode(X.chunk_starts(F.col("text"))).alias("k"))
    part = F.substring("text", F.col("k") + 1, F.lit(4800))
    return cut.select("doc_id", F.col("k").cast("long").alias("start"), F.length(part).cast("long").alias("n"), F.sha2(part, 256).alias("sha"))


@query("documents", sql=f"""
WITH s AS (SELECT doc_id, unnest({_SENT}) AS s FROM documents), w AS (SELECT doc_id, len({_WORDS.format("s")}) AS n FROM s)
SELECT doc_id, count(*) AS sentences, round(avg(n), 4) AS average, round(stddev_pop(n), 4) AS spread, round(avg((n >= 18)::INT), 4) AS long_share FROM w GROUP BY 1""")  # fmt: skip
def sentence_stats(documents: DataFrame) -> DataFrame:
    n = documents.select("doc_id", F.explode(X.sentences(F.col("text"))).alias("s")).select("doc_id", X.word_count(F.col("s")).alias("n"))
    return n.groupBy("doc_id").agg(F.count("*").alias("sentences"), F.round(F.avg("n"), 4).alias("average"), F.round(F.stddev_pop("n"), 4).alias("spread"), F.round(F.avg((F.col("n") >= 18).cast("int")), 4).alias("long_share"))


_VOWELS = "len(regexp_extract_all(v, '[aeiouy]+'))"
_SOUNDS = f"CASE WHEN v = '' THEN 0 ELSE greatest(1, {_VOWELS} - (ends_with(v, 'e') AND {_VOWELS} > 1 AND NOT ends_with(v, 'le') AND NOT ends_with(v, 'ee'))::INT) END"


@query("conversations", sql=f"""
WITH t AS (SELECT conv_id, turn, len(list_filter({_SENT}, lambda s: len(string_split(s, ' ')) > 2)) AS s, regexp_extract_all(text, '[A-Za-z][A-Za-z''-]*') AS w FROM conversations),
y AS (SELECT *, coalesce(list_sum(list_transform(list_transform(w, lambda x: lower(regexp_replace(x, '[^A-Za-z]', '', 'g'))), lambda v: {_SOUNDS})), 0) AS y FROM t)
SELECT conv_id, turn, len(w) AS words, y::BIGINT AS syllables, coalesce(round_even(206.835::DOUBLE - 1.015::DOUBLE * (len(w) / nullif(s, 0)) - 84.6::DOUBLE * (y / nullif(len(w), 0)), 1), 0) AS ease FROM y""")  # fmt: skip
def reading_ease(conversations: DataFrame) -> DataFrame:
    t = F.col("text")
    found = X.plain_words(t)
    sounds = F.aggregate(F.transform(found, X.syllables), F.lit(0), lambda a, b: a + b)
    return conversations.select("conv_id", "turn", F.size(found).cast("long").alias("words"), sounds.cast("long").alias("syllables"), X.reading_ease(t).alias("ease"))


@query("documents", sql=f"""
WITH w AS (SELECT lower(unnest(regexp_extract_all(text, '[A-Za-z][A-Za-z''-]*'))) AS word FROM documents), v AS (SELECT word, regexp_replace(word, '[^a-z]', '', 'g') AS v FROM w)
SELECT word, count(*) AS n FROM v WHERE {_SOUNDS} >= 4 GROUP BY 1 ORDER BY n DESC, word LIMIT 22""")  # fmt: skip
def hard_words(documents: DataFrame) -> DataFrame:
    """The 22 commonest words of four syllables or more."""
    found = documents.select(F.explode(X.plain_words(F.col("text"))).alias("w")).where(X.syllables(F.col("w")) >= 4)
    return found.groupBy(F.lower("w").alias("word")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word").limit(22)


@query("documents", sql=rf"""
WITH p AS (SELECT doc_id, unnest(string_split(regexp_replace(text, '\n\s*\n', '␟', 'g'), '␟')) AS text FROM documents),
s AS (SELECT doc_id, text, {_SENT} AS s FROM p)
SELECT doc_id, coalesce(sum(len(list_filter(s, lambda x: len(string_split(x, ' ')) > 25 AND NOT contains(x, '|') AND NOT regexp_matches(x, '^[-*]')))), 0)::BIGINT AS long_sentences,
  count(*) FILTER (WHERE len(s) > 5 AND NOT regexp_matches(trim(text), '^(?:[-*+]\s|\d+[.)]\s)')) AS fat_paragraphs FROM s GROUP BY 1""")  # fmt: skip
def long_and_fat(documents: DataFrame) -> DataFrame:
    """Sentences of over 25 words, rows of tables and items left out, and paragraphs of over five sentences, lists left out."""
    parts = documents.select("doc_id", F.explode(F.split("text", r"\n\s*\n")).alias("p")).select("doc_id", "p", X.sentences(F.col("p")).alias("s"))
    long = F.size(F.filter("s", lambda x: (X.word_count(x) > 25) & ~F.contains(x, F.lit("|")) & ~x.rlike("^[-*]")))
    fat = (F.size("s") > 5) & ~F.trim("p").rlike(r"^(?:[-*+]\s|\d+[.)]\s)")
    return parts.groupBy("doc_id").agg(F.sum(long).cast("long").alias("long_sentences"), F.count_if(fat).alias("fat_paragraphs"))


@query("documents", sql=r"""
SELECT doc_id, len(n) AS n, array_to_string(list_sort(n), ' ') AS numbers FROM (SELECT doc_id, list_distinct(list_transform(regexp_extract_all(text, '(\d[\d,.]*\d)', 1), lambda x: regexp_replace(x, ',', '', 'g'))) AS n FROM documents)""")  # fmt: skip
def number_sets(documents: DataFrame) -> DataFrame:
    n = X.numbers(F.col("text"))
    return documents.select("doc_id", F.size(n).cast("long").alias("n"), F.array_join(F.array_sort(n), " ").alias("numbers"))


@query("documents", sql=r"SELECT doc_id, md5(regexp_replace(regexp_replace(lower(text), '(\d),(\d)', '\1\2', 'g'), '[^a-z0-9%]+', ' ', 'g')) AS key FROM documents")
def number_normalise(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", F.md5(X.normal_number(F.col("text"))).alias("key"))


@query("documents", sql=r"""
SELECT doc_id, len(regexp_extract_all(lower(text), '\bof[\s-]+the\b')) AS of_the, len(regexp_extract_all(lower(text), '\band\b')) AS and_n FROM documents""")  # fmt: skip
def phrase_counts(documents: DataFrame) -> DataFrame:
    t = F.col("text")
    return documents.select("doc_id", X.phrase_count(t, "of the").cast("long").alias("of_the"), X.phrase_count(t, "and").cast("long").alias("and_n"))


@query("documents")
def number_normalise_all(documents: DataFrame) -> DataFrame:
    """The same as number_normalise; tested against Python."""
    return documents.select("doc_id", F.md5(X.normal_number(F.col("text"))).alias("key"))


@query("documents")
def phrase_counts_all(documents: DataFrame) -> DataFrame:
    """The same as phrase_counts; tested against Python."""
    t = F.col("text")
    return documents.select("doc_id", X.phrase_count(t, "of the").cast("long").alias("of_the"), X.phrase_count(t, "and").cast("long").alias("and_n"))


@query("documents", sql="SELECT CASE WHEN length(text) < 250 THEN 'failed' WHEN length(text) < 400 THEN 'stub' ELSE 'ok' END AS status, lang, count(*) AS n FROM documents GROUP BY 1, 2")
def body_status(documents: DataFrame) -> DataFrame:
    return documents.groupBy(X.body_status(F.col("text")).alias("status"), "lang").agg(F.count("*").alias("n"))


@query("documents", sql=r"""
SELECT doc_id, len(regexp_extract_all(text, '—')) AS dashes, len(regexp_extract_all(text, '[!?]')) AS marks, len(regexp_extract_all(text, '\[[A-Z ]+\]')) AS placeholders FROM documents""")  # fmt: skip
def slop_counts(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", *[F.regexp_count("text", F.lit(p)).cast("long").alias(n) for n, p in (("dashes", "—"), ("marks", "[!?]"), ("placeholders", r"\[[A-Z ]+\]"))])


@query("documents", sql="""
WITH p AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) SELECT doc_id, count(*) AS lines, count(*) FILTER (WHERE NOT regexp_matches(line, '^(#|[|]|[-*] )') AND trim(line) <> '') AS prose FROM p GROUP BY 1""")  # fmt: skip
def prose_lines(documents: DataFrame) -> DataFrame:
    lines = documents.select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    return lines.groupBy("doc_id").agg(F.count("*").alias("lines"), F.count_if(~F.col("line").rlike("^(#|[|]|[-*] )") & (F.trim("line") != "")).alias("prose"))


@query("conversations", sql=f"""
WITH w AS (SELECT unnest({_WORDS.format("lower(text)")}) AS w FROM conversations)
SELECT CASE {" ".join(f"WHEN w LIKE '%{x}' AND length(w) > {len(x) + 2} THEN left(w, -{len(x)})" for x in X.SUFFIXES)} ELSE w END AS stem, count(*) AS n FROM w GROUP BY 1""")  # fmt: skip
def stems(conversations: DataFrame) -> DataFrame:
    w = conversations.select(F.explode(X.words(F.lower("text"))).alias("w"))
    return w.groupBy(X.stem(F.col("w")).alias("stem")).agg(F.count("*").alias("n"))


@query("documents")
def scrub(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", X.scrub(F.col("text")).alias("text"))


def _edited(conversations: DataFrame) -> DataFrame:
    before = conversations.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("before"))
    return conversations.join(before, ["conv_id", "turn"]).select("conv_id", "turn", word_edits("before", "text").alias("d"))


@query("conversations")
def word_diff(conversations: DataFrame) -> DataFrame:
    """How alike each turn is to the one before it: twice the words that stay, in order, by those of both."""
    return _edited(conversations).select("conv_id", "turn", F.col("d.similarity").alias("ratio"))


@query("conversations")
def section_edits(conversations: DataFrame) -> DataFrame:
    """What was changed from each turn to the next, in order, as words that were and words that are now. Tested against a table of all pairs, without SQL."""
    edits = _edited(conversations).select("conv_id", "turn", "d.similarity", F.posexplode("d.edits").alias("pos", "e"))
    return edits.select("conv_id", "turn", "similarity", "pos", "e.op", "e.was", "e.now")
