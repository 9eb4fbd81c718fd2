"""Citation tags and numbered references, phrases and where they stand, and measures of answers."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from .registry import query

#: Texts with tags put in: a range, touching tags, one too wide and one reversed.
_TAGGED = "text || ' [c' || conv_id || '–c' || (conv_id + turn) || ', 7]. More [c5][ c' || turn || ', c5 ] here [c9-c2] and [c1-c90] .42 [12]'"
_DASHES = r"\s*[-\x{2010}-\x{2015}]\s*[cC]?\s*"
_SPELLED = rf"""flatten(list_transform(list_filter(regexp_split_to_array(§, '[,\[\]]'), lambda p: regexp_matches(p, '\d')), lambda p: CASE
  WHEN NOT regexp_matches(p, '\d{_DASHES}\d') THEN [regexp_extract(p, '(\d+)', 1)::BIGINT]
  WHEN regexp_extract(p, '\d+{_DASHES}(\d+)', 1)::BIGINT > regexp_extract(p, '(\d+)', 1)::BIGINT AND regexp_extract(p, '\d+{_DASHES}(\d+)', 1)::BIGINT - regexp_extract(p, '(\d+)', 1)::BIGINT <= 60
    THEN range(regexp_extract(p, '(\d+)', 1)::BIGINT, regexp_extract(p, '\d+{_DASHES}(\d+)', 1)::BIGINT + 1)
  ELSE [regexp_extract(p, '(\d+)', 1)::BIGINT, regexp_extract(p, '\d+{_DASHES}(\d+)', 1)::BIGINT] END))"""
_BLOCK = rf"\[\s*[cC]\s*\d+(?:{_DASHES}\d+)?(?:\s*,\s*[cC]?\s*\d+(?:{_DASHES}\d+)?)*\s*\]"


def _tagged(conversations: DataFrame) -> DataFrame:
    c, t = F.col("conv_id"), F.col("turn")
    text = F.concat(F.col("text"), F.lit(" [c"), c, F.lit("–c"), c + t, F.lit(", 7]. More [c5][ c"), t, F.lit(", c5 ] here [c9-c2] and [c1-c90] .42 [12]"))
    return conversations.select("conv_id", "turn", text.alias("t"))


@query("conversations", sql=f"""
WITH t AS (SELECT conv_id, turn, {_TAGGED} AS t FROM conversations)
SELECT conv_id, turn, array_to_string(flatten(list_transform(regexp_extract_all(t, '{_BLOCK}'), lambda b: {_SPELLED.replace("§", "b")})), ' ') AS ids FROM t""")  # fmt: skip
def tag_references(conversations: DataFrame) -> DataFrame:
    """The ids of the tags of a text in order, ranges spelled out."""
    return _tagged(conversations).select("conv_id", "turn", F.array_join(X.tag_ids(F.col("t")).cast("array<string>"), " ").alias("ids"))


@query("conversations", sql="""
SELECT conv_id, turn, text || ' [c' || conv_id || '–c' || (conv_id + turn) || ', 7]. More ' || CASE WHEN turn = 5 THEN '[c5]' ELSE '[c5, c' || turn || ']' END || ' here [c9-c2] and [c1-c90] .42 [12]' AS merged FROM conversations""")  # fmt: skip
def merged_tags(conversations: DataFrame) -> DataFrame:
    """Touching tags become one, each id once."""
    return _tagged(conversations).select("conv_id", "turn", X.merge_tags(F.col("t")).alias("merged"))


@query("conversations", sql=f"""
WITH t AS (SELECT conv_id, turn, {_TAGGED} AS t FROM conversations), b AS (SELECT conv_id, turn, {_SPELLED.replace("§", "regexp_extract(t, '" + _BLOCK + "')")} AS own FROM t),
k AS (SELECT *, list_filter(own, lambda i: i NOT IN (5, 7, 9, 2)) AS kept, turn NOT IN (5, 7, 9, 2) AS other FROM b)
SELECT conv_id, turn, trim(regexp_replace(regexp_replace(text || ' ' || CASE WHEN len(kept) > 0 THEN '[' || array_to_string(list_transform(kept, lambda i: 'c' || i), ', ') || ']' ELSE '' END || '. More ' || CASE WHEN other THEN '[c' || turn || ']' ELSE '' END
  || ' here ' || ' and [c1, c90] .42 [12]', '[ \\t]{{2,}}', ' ', 'g'), '\\s+([.,;:])([^0-9]|$)', '\\1\\2', 'g')) AS left_over FROM k JOIN conversations USING (conv_id, turn)""")  # fmt: skip
def dropped_tags(conversations: DataFrame) -> DataFrame:
    """Texts without the ids 5, 7, 9 and 2; a full stop before a digit keeps its space."""
    gone = F.array(*[F.lit(i).cast("long") for i in (5, 7, 9, 2)])
    return _tagged(conversations).select("conv_id", "turn", X.drop_tags(F.col("t"), gone).alias("left_over"))


@query("conversations", sql=f"""
WITH t AS (SELECT conv_id, turn, {_TAGGED} AS t FROM conversations), i AS (SELECT conv_id, turn, unnest(flatten(list_transform(regexp_extract_all(t, '{_BLOCK}'), lambda b: {_SPELLED.replace("§", "b")}))) AS id FROM t)
SELECT conv_id, turn, count(DISTINCT id) FILTER (WHERE id IN (5, 9, 60)) AS cited, count(*) FILTER (WHERE id NOT IN (5, 9, 60)) AS unknown FROM i GROUP BY 1, 2""")  # fmt: skip
def provenance(conversations: DataFrame) -> DataFrame:
    """How many known cards a text cites, and how many of its tags name none."""
    ids = _tagged(conversations).select("conv_id", "turn", F.explode(X.tag_ids(F.col("t"))).alias("id"))
    known = F.col("id").isin(5, 9, 60)
    return ids.groupBy("conv_id", "turn").agg(F.count_distinct(F.when(known, F.col("id"))).alias("cited"), F.count_if(~known).alias("unknown"))


@query("conversations", sql=r"""
WITH s AS (SELECT conv_id, turn, unnest(string_split(regexp_replace(text || ' [c' || turn || ']', '([.!?])\s', '\1␞', 'g'), '␞')) AS s FROM conversations)
SELECT conv_id, turn, right(trim(regexp_extract(s, '(?s)^(.*)\[c\d+\]$', 1)), 160) AS claim FROM s WHERE regexp_matches(s, '\[c\d+\]$')""")  # fmt: skip
def tag_claims(conversations: DataFrame) -> DataFrame:
    """The sentence before each tag, at most its last 160 characters."""
    text = F.concat(F.col("text"), F.lit(" [c"), "turn", F.lit("]"))
    part = conversations.select("conv_id", "turn", F.explode(F.split(F.regexp_replace(text, r"([.!?])\s", f"$1{X.MARK}"), X.MARK)).alias("s")).where(F.col("s").rlike(r"\[c\d+\]$"))
    return part.select("conv_id", "turn", F.right(F.trim(F.regexp_extract("s", r"(?s)^(.*)\[c\d+\]$", 1)), F.lit(160)).alias("claim"))


_NUMBERED = "text || ' [' || (turn + 3) || '] and [2, 4] then [' || conv_id || '][3] [' || (turn + 3) || ']'"


def _numbered(conversations: DataFrame) -> DataFrame:
    c, t = F.col("conv_id"), F.col("turn")
    text = F.concat(F.col("text"), F.lit(" ["), t + 3, F.lit("] and [2, 4] then ["), c, F.lit("][3] ["), t + 3, F.lit("]"))
    return conversations.select("conv_id", "turn", text.alias("t"))


@query("conversations", sql=rf"""
WITH t AS (SELECT conv_id, turn, {_NUMBERED} AS t FROM conversations)
SELECT conv_id, turn, regexp_replace(t, '\[\d+(?:,\s*\d+)*\]', '', 'g') AS bare, array_to_string(regexp_extract_all(t, '\[(\d+)\]', 1), ' ') AS cited FROM t""")  # fmt: skip
def numbered_citations(conversations: DataFrame) -> DataFrame:
    """Texts without their numbered citations, and the numbers that stand alone in brackets."""
    t = F.col("t")
    return _numbered(conversations).select("conv_id", "turn", X.remove_citations(t).alias("bare"), F.array_join(X.citation_indices(t).cast("array<string>"), " ").alias("cited"))


def first_uses(texts: DataFrame, key: list[str], order: list[str], text: str) -> DataFrame:
    """(key, old, new): the numbers cited in the texts of a key, numbered anew by where they stand first. Windows run over one key's numbers."""
    each = texts.select(*key, *order, F.posexplode(X.citation_indices(F.col(text))).alias("pos", "old"))
    first = each.groupBy(*key, "old").agg(F.min(F.struct(*order, "pos")).alias("at"))
    return first.select(*key, "old", F.row_number().over(Window.partitionBy(*key).orderBy("at")).cast("long").alias("new"))


@query("conversations", sql=rf"""
WITH t AS (SELECT conv_id, turn, {_NUMBERED} AS t FROM conversations), i AS (SELECT conv_id, turn, unnest(regexp_extract_all(t, '\[(\d+)\]', 1))::BIGINT AS old, generate_subscripts(regexp_extract_all(t, '\[(\d+)\]', 1), 1) AS pos FROM t),
f AS (SELECT conv_id, old, min(turn * 1000 + pos) AS at_ FROM i GROUP BY 1, 2), n AS (SELECT conv_id, old, row_number() OVER (PARTITION BY conv_id ORDER BY at_) AS new_ FROM f),
m AS (SELECT t.conv_id, t.turn, a.new_ AS a, b.new_ AS b, c.new_ AS c FROM t JOIN n a ON a.conv_id = t.conv_id AND a.old = t.turn + 3 JOIN n b ON b.conv_id = t.conv_id AND b.old = t.conv_id JOIN n c ON c.conv_id = t.conv_id AND c.old = 3)
SELECT conv_id, turn, text || ' [' || a || '] and [2, 4] then [' || b || '][' || c || '] [' || a || ']' AS t FROM m JOIN conversations USING (conv_id, turn)""")  # fmt: skip
def renumbered(conversations: DataFrame) -> DataFrame:
    """Citations numbered by first use over a conversation, texts rewritten so; a citation keeps its number in all its places."""
    t = _numbered(conversations)
    numbers = first_uses(t, ["conv_id"], ["turn"], "t")
    map_ = numbers.groupBy("conv_id").agg(F.map_from_entries(F.collect_list(F.struct(F.col("old").cast("string"), "new"))).alias("numbers"))
    return t.join(map_, "conv_id", "left").select("conv_id", "turn", X.remap_citations(F.col("t"), F.col("numbers")).alias("t"))


@query("conversations", sql=rf"""
WITH t AS (SELECT conv_id, {_NUMBERED} AS t FROM conversations), c AS (SELECT DISTINCT conv_id, unnest(regexp_extract_all(t, '\[(\d+)\]', 1))::BIGINT AS old FROM t), r AS (SELECT conv_id, old FROM (SELECT DISTINCT conv_id FROM conversations) CROSS JOIN (SELECT unnest(range(1, 8)) AS old))
SELECT conv_id, count(*) FILTER (WHERE c.old IS NOT NULL) AS kept, count(*) FILTER (WHERE c.old IS NULL) AS deleted FROM r LEFT JOIN c USING (conv_id, old) GROUP BY 1""")  # fmt: skip
def unused_references(conversations: DataFrame) -> DataFrame:
    """Of seven references of each conversation, how many are cited and stay, and how many go."""
    listed = conversations.select("conv_id").distinct().select("conv_id", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(7).cast("long"))).alias("old"))
    used = _numbered(conversations).select("conv_id", F.explode(X.citation_indices(F.col("t"))).alias("old")).distinct().withColumn("used", F.lit(True))
    return listed.join(used, ["conv_id", "old"], "left").groupBy("conv_id").agg(F.count("used").alias("kept"), F.count_if(F.col("used").isNull()).alias("deleted"))


@query("conversations", sql=r"""
SELECT conv_id, turn, md5(CASE WHEN regexp_matches(text, '[.!?]') THEN trim(regexp_extract(text, '(?s)^(.*[.!?]\s*)', 1)) ELSE text END) AS whole FROM conversations""")  # fmt: skip
def last_whole_sentence(conversations: DataFrame) -> DataFrame:
    return conversations.select("conv_id", "turn", F.md5(X.whole_sentences(F.col("text"))).alias("whole"))


def limited_words(text, most: int):
    """The first words of a text, at most so many, with its line breaks; runs of spaces become one."""
    lines = F.transform(F.split(text, "\n"), X.words)
    sizes = F.transform(lines, F.size)
    before = lambda i: F.aggregate(F.slice(sizes, F.lit(1), i), F.lit(0), lambda a, n: a + n)
    cut = F.transform(lines, lambda line, i: F.when(before(i) < most, F.array_join(F.slice(line, F.lit(1), F.greatest(most - before(i), F.lit(1))), " ")))
    return F.trim(F.array_join(F.filter(cut, lambda line: line.isNotNull()), "\n"), F.lit(" \n"))


@query("conversations", sql=r"""
WITH l AS (SELECT conv_id, turn, list_transform(string_split(text, chr(10)), lambda x: list_filter(string_split(regexp_replace(x, '\s+', ' ', 'g'), ' '), lambda w: w <> '')) AS l FROM conversations),
b AS (SELECT conv_id, turn, l, list_transform(l, lambda x, i: coalesce(list_sum(list_transform(l[1:i - 1], lambda y: len(y))), 0)::BIGINT) AS b FROM l)
SELECT conv_id, turn, md5(trim(array_to_string(list_filter(list_transform(l, lambda x, i: CASE WHEN b[i] < 40 THEN array_to_string(x[1:greatest(40 - b[i], 1)], ' ') END), lambda x: x IS NOT NULL), chr(10)), ' ' || chr(10))) AS t FROM b""")  # fmt: skip
def word_limits(conversations: DataFrame) -> DataFrame:
    return conversations.select("conv_id", "turn", F.md5(limited_words(F.col("text"), 40)).alias("t"))


@query("part", sql=r"""
WITH h AS (SELECT p_partkey, p_brand || CASE p_size % 5 WHEN 0 THEN ' ISO 27001 guide' WHEN 1 THEN ': 7 facts' WHEN 2 THEN ' Step 2' WHEN 3 THEN ' up 40%' ELSE ' cold-widget review' END AS h, p_name AS k FROM part)
SELECT p_partkey, regexp_matches(regexp_replace(replace(h, '#', '-'), '(?i)(?:fortune|iso|type|tier|level|section|step|part|chapter|covid|gpt|g)[\s-]*\d+', '', 'g'), '\d') AS figure,
  contains(array_to_string(regexp_extract_all(lower(h), '[a-z0-9]+'), ' '), array_to_string(regexp_extract_all(lower(k), '[a-z0-9]+'), ' ')) AS holds FROM h""")  # fmt: skip
def heading_checks(part: DataFrame) -> DataFrame:
    """Whether a heading has a figure that is no name's, and whether it holds a phrase whatever its case and hyphens."""
    k = F.col("p_size") % 5
    h = F.concat("p_brand", F.when(k == 0, " ISO 27001 guide").when(k == 1, ": 7 facts").when(k == 2, " Step 2").when(k == 3, " up 40%").otherwise(" cold-widget review"))
    return part.select("p_partkey", X.has_figure(F.replace(h, F.lit("#"), F.lit("-"))).alias("figure"), F.contains(X.flat(h), X.flat(F.col("p_name"))).alias("holds"))


_AT = r"len(regexp_extract_all(lower({}), '\b{}\b'))"
_FIRST = r"array_to_string(list_filter(string_split(regexp_replace(text, '\s+', ' ', 'g'), ' '), lambda w: w <> '')[1:100], ' ')"


@query("benchmark", sql=rf"""
WITH b AS (SELECT item_id, left(text, 60) AS h1, text AS body, right(text, 80) AS "close", {_FIRST} AS opening FROM benchmark), p AS (SELECT unnest(['the', 'in the', 'was']) AS phrase)
SELECT item_id, phrase, CASE phrase {" ".join(f"WHEN '{p}' THEN {_AT.format('body', p.replace(' ', r'[\s-]+'))}" for p in ("the", "in the", "was"))} END AS total,
  CASE phrase {" ".join(f"WHEN '{p}' THEN {_AT.format('h1', p.replace(' ', r'[\s-]+'))} > 0" for p in ("the", "in the", "was"))} END AS in_h1,
  CASE phrase {" ".join(f"WHEN '{p}' THEN {_AT.format('opening', p.replace(' ', r'[\s-]+'))} > 0" for p in ("the", "in the", "was"))} END AS in_first_100_words,
  CASE phrase {" ".join(f"WHEN '{p}' THEN {_AT.format('close', p.replace(' ', r'[\s-]+'))} > 0" for p in ("the", "in the", "was"))} END AS in_close FROM b CROSS JOIN p""")  # fmt: skip
def phrase_matrix(benchmark: DataFrame) -> DataFrame:
    """Where each of three phrases stands in each text: in its title, its first hundred words, its end."""
    first = F.array_join(F.slice(X.words(F.col("text")), 1, 100), " ")
    parts = benchmark.select("item_id", F.left("text", F.lit(60)).alias("h1"), F.col("text").alias("body"), F.right("text", F.lit(80)).alias("close"), first.alias("opening"))

    def row(phrase: str):
        at = lambda c: X.phrase_count(F.col(c), phrase)
        return F.struct(F.lit(phrase).alias("phrase"), at("body").cast("long").alias("total"), (at("h1") > 0).alias("in_h1"), (at("opening") > 0).alias("in_first_100_words"), (at("close") > 0).alias("in_close"))

    return parts.select("item_id", F.inline(F.array(*map(row, ("the", "in the", "was")))))


@query("conversations", sql=r"""
WITH a AS (SELECT conv_id, string_agg(text, ' ' ORDER BY turn) FILTER (WHERE turn % 3 <> 0) AS article FROM conversations GROUP BY 1)
SELECT conv_id, turn, len(list_filter(string_split(regexp_replace(text, '\s+', ' ', 'g'), ' '), lambda w: w <> '')) AS words, len(list_filter(string_split(regexp_replace(text, '\s+', ' ', 'g'), ' '), lambda w: w <> '')) > 50 AS over_target,
  array_to_string(list_sort(list_filter(list_distinct(regexp_extract_all(text || ' ' || conv_id || ' and ' || turn, '\d[\d,]*\.?\d*%?')), lambda n: NOT list_contains(regexp_extract_all(coalesce(article, '') || ' ' || turn, '\d[\d,]*\.?\d*%?'), n))), ' ') AS outside
FROM conversations JOIN a USING (conv_id) WHERE turn % 3 = 0""")  # fmt: skip
def answer_measures(conversations: DataFrame) -> DataFrame:
    """Words of each answer, whether they are over the target of 50, and figures that the rest of its conversation doesn't have."""
    number = F.lit(r"\d[\d,]*\.?\d*%?")
    rest = conversations.where("turn % 3 != 0").groupBy("conv_id").agg(F.flatten(F.collect_list(F.regexp_extract_all("text", number, F.lit(0)))).alias("known"))
    answers = conversations.where("turn % 3 = 0").join(rest, "conv_id", "left")
    own = F.array_distinct(F.regexp_extract_all(F.concat("text", F.lit(" "), "conv_id", F.lit(" and "), "turn"), number, F.lit(0)))
    known = F.concat(F.coalesce("known", F.array().cast("array<string>")), F.array(F.col("turn").cast("string")))
    n = X.word_count(F.col("text")).cast("long")
    return answers.select("conv_id", "turn", n.alias("words"), (n > 50).alias("over_target"), F.array_join(F.array_sort(F.array_except(own, known)), " ").alias("outside"))
