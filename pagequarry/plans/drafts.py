"""Drafts and what guards them: topics by rules, JSON in prose, anchors, outlines, sections, edits and phrases."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators.ranking import numbered
from ..operators.relational import first_match
from .registry import query

#: Topic, part of it and the pattern of a slug, in order; the first that fits counts.
TOPICS = [
    ("Interview Questions (by role)", "", r"interview-question"),
    ("Hiring by Role", "", r"(^|-)how-to-hire-|(^|/)hire-[a-z]|-hiring-guide"),
    ("Screening by Skill/Role", "", r"screen-candidates-for|screen-candidates|screening-|to-screen-"),
    ("Skills Tests & Evaluation (by skill)", "", r"evaluate-.*skill|assess-.*skill|-skills?-(test|assessment)|skills?-of-a"),
    ("Assessments & Testing", "Personality & Psychometric", r"personality|disc|psychometric|myers|big-five|enneagram|16-?personalit"),
    ("Assessments & Testing", "Aptitude & Cognitive", r"aptitude|cognitive|numerical|verbal-reasoning|logical|abstract-reasoning|iq-test"),
    ("Assessments & Testing", "Pre-employment / Pre-hire", r"pre-employment|pre-hire|pre-screen"),
    ("Assessments & Testing", "Proctoring & Integrity", r"proctor|cheat|dishonest|fraud|credibility|background-check|reference-check|validity|blind-hiring"),
    ("Assessments & Testing", "Assessment general", r"assessment|-test(s|ing)?(-|$)|talent-test|skill-test|typing-test|coding-test|situational-judg"),
    ("Competitor Alternatives & Comparisons", "", r"alternatives?$|-vs-|comparison"),
    ("Recruiting & Talent Acquisition", "Sourcing & Candidate Pool", r"sourc|talent-pool|candidate-pool|talent-pipeline|passive-candidate|find-.*(worker|candidate|talent)"),
    (
        "Recruiting & Talent Acquisition", "Recruitment Process & Strategy",
        r"recruit|talent-acquisition|applicant|ats|hiring-process|hiring-strateg|selection-process|candidate-experience",
    ),
    ("Recruiting & Talent Acquisition", "Interviewing (process/skills)", r"interview"),
    (
        "Skills Management", "",
        r"skills?-(management|mapping|gap|matrix|framework|taxonomy|based|inventory|audit|develop|mismatch)|competency|upskill|reskill|skill-gap|soft-skill|"
        r"transferable-skill|hard-skill|leadership-skill",
    ),
    ("HR Operations & Compliance", "Compensation & Benefits", r"salary|compensation|payroll|benefit|bonus|wage|garden-leave|pto|leave-|paid-time"),
    ("HR Operations & Compliance", "Policies & Compliance", r"policy|compliance|labor-law|eeoc|gdpr|discrimination|harassment|work-schedule|9-80|workweek"),
    (
        "HR Operations & Compliance", "Workforce & Succession Planning",
        r"succession|workforce-planning|internal-mobility|job-analysis|organizational-structure|org-structure|job-characteristics|headcount|capacity-planning",
    ),
    ("HR Operations & Compliance", "HR general / HRM", r"(^|/)hr-|human-resource|hrm|people-ops|people-management|hr-tech|hris|hr-toolkit|hr-case"),
    ("Employee Experience & Development", "Onboarding", r"onboard"),
    (
        "Employee Experience & Development", "Engagement & Retention",
        r"engagement|retention|turnover|attrition|employee-experience|morale|recognition|wellbeing|well-being|burnout|satisfaction",
    ),
    (
        "Employee Experience & Development", "Performance & L&D",
        r"performance-(review|management|appraisal)|training|learning-and-development|l-and-d|career-development|mentor|coaching",
    ),
    ("Employee Experience & Development", "Employee general", r"employee|workforce|staff"),
    ("Workplace, Culture & Future of Work", "Remote & Hybrid", r"remote|work-from-home|hybrid|distributed-team|wfh"),
    ("Workplace, Culture & Future of Work", "DEI", r"diversity|inclusion|dei|equity|belonging|bias"),
    ("Workplace, Culture & Future of Work", "Culture & Trends", r"culture|future-of-work|workplace|trend|great-resignation|quiet-quit|employer-brand"),
    ("Career & Role Guides", "", r"how-to-become|career-path|job-description|what-does-a-.*-do|-career|day-in-the-life"),
    (
        "Recruiting & Talent Acquisition", "General Hiring",
        r"hir(e|ing)|bad-hire|offer-letter|job-board|job-application|job-offer|job-posting|onboarding-vs|new-hire|time-to-fill|quality-of-hire",
    ),
    ("Recruiting & Talent Acquisition", "General Talent/Team-building", r"team|leader|manage(r|ment)|talent|workforce|productivity|collaboration"),
]
#: Format and the pattern of a URL that tells it, in order; the first that fits counts.
FORMATS = [
    ("Definitional / pillar", r"(?i)what-|definition|types-of"),
    ("Listicle", r"(?i)top-\d|-questions|\d+-ways"),
    ("Step-by-step how-to", r"(?i)how-to|-process|-steps"),
    ("Comparison", r"(?i)-vs-|alternatives"),
]
#: How a page that isn't there says so.
SOFT_404 = (
    r"(?i)\b(page not found|404 error|page you (are|were) looking for (does not|doesn't) exist|this page (does not|doesn't) exist|"
    r"nothing (was )?found|content not available|sorry,? (we )?(can'?t|could not|couldn'?t) find)\b"
)
LINK = r"\[([^\]\[]+)\]\((https?://[^)\s]+)\)"
ITEM = r"^(?:[-*+] |\d+\.\s)"

#: Beginnings of the slugs that the queries below make of part names.
_OPENINGS = [
    "how-to-hire-a-", "salary-of-a-", "remote-", "onboarding-a-", "best-", "team-of-", "interview-questions-for-", "diversity-and-", "skills-gap-in-", "ats-vs-",
    "engagement-of-", "top-10-", "performance-review-of-", "screening-", "what-is-a-", "proctor-a-", "personality-of-", "hr-tech-for-", "a-career-in-", "aptitude-for-",
]
_SLUG_SQL = f"[{', '.join(repr(o) for o in _OPENINGS)}][p_partkey % {len(_OPENINGS)} + 1] || replace(lower(p_name), ' ', '-')"


def _slug() -> Column:
    openings = F.array(*map(F.lit, _OPENINGS))
    return F.concat(F.get(openings, F.col("p_partkey") % len(_OPENINGS)), F.replace(F.lower("p_name"), F.lit(" "), F.lit("-")))


def _cases(rules: list[tuple[str, str]]) -> str:
    return " ".join("WHEN regexp_matches(slug, '{}') THEN '{}'".format(p.replace("'", "''"), n.replace("'", "''")) for n, p in rules)


@query("part", sql=f"""
SELECT p_partkey, CASE {_cases([(c, p) for c, _, p in TOPICS])} ELSE 'Unclustered / Other' END AS topic, CASE {_cases([(s, p) for _, s, p in TOPICS])} ELSE '' END AS subtopic
FROM (SELECT p_partkey, {_SLUG_SQL} AS slug FROM part)""")  # fmt: skip
def slug_topics(part: DataFrame) -> DataFrame:
    """Topic and part of it for each slug, by the first rule that fits."""
    topic = first_match([(c, F.col("slug").rlike(p)) for c, _, p in TOPICS], "Unclustered / Other")
    subtopic = first_match([(s, F.col("slug").rlike(p)) for _, s, p in TOPICS], "")
    return part.select("p_partkey", _slug().alias("slug")).select("p_partkey", topic.alias("topic"), subtopic.alias("subtopic"))


@query("part", sql=f"SELECT p_partkey, CASE {_cases(FORMATS)} ELSE 'Thought-leadership / other' END AS format FROM (SELECT p_partkey, {_SLUG_SQL} AS slug FROM part)")
def slug_formats(part: DataFrame) -> DataFrame:
    return part.select("p_partkey", _slug().alias("slug")).select("p_partkey", first_match([(n, F.col("slug").rlike(p)) for n, p in FORMATS], "Thought-leadership / other").alias("format"))


def read_status(body: Column, least_words: int = 80) -> Column:
    """Why a body can't be read: short (none too), soft-404 by what its first 1,200 characters say; ok otherwise."""
    words = X.word_count(F.coalesce(body, F.lit("")))
    return F.when(words < least_words, "short").when(F.substring(body, 1, 1200).rlike(SOFT_404), "soft-404").otherwise("ok")


_WORDS = r"len(list_filter(string_split(regexp_replace({}, '\s+', ' ', 'g'), ' '), lambda w: w <> ''))"


@query("documents", sql=f"""
WITH b AS (SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN 'Sorry, we could not find it. ' || text WHEN 1 THEN text || ' Page not found' ELSE text END AS body FROM documents)
SELECT doc_id, CASE WHEN {_WORDS.format("body")} < 80 THEN 'short' WHEN regexp_matches(substr(body, 1, 1200), '{SOFT_404.replace("'", "''")}') THEN 'soft-404' ELSE 'ok' END AS status FROM b""")  # fmt: skip
def read_statuses(documents: DataFrame) -> DataFrame:
    kind = F.col("doc_id") % 7
    body = F.when(kind == 0, F.concat(F.lit("Sorry, we could not find it. "), "text")).when(kind == 1, F.concat("text", F.lit(" Page not found"))).otherwise(F.col("text"))
    return documents.select("doc_id", read_status(body).alias("status"))


def _stripped(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def first_json(text: Column) -> Column:
    """The first balanced JSON object or array in prose or between code fences; null if there is none or it isn't valid."""
    parts = F.transform(F.split(text, "```"), lambda p: F.regexp_replace(_stripped(p), r"^json\s*", ""))
    source = F.coalesce(F.get(F.filter(parts, lambda p: p.rlike(r"^[{\[]")), F.lit(0)), text)
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("depth"), F.lit(False).alias("quoted"), F.lit(False).alias("escaped"), F.lit(0).alias("end"))

    def balanced(tokens: Column) -> Column:
        opens = F.get(tokens, F.lit(0))
        closes = F.when(opens == "{", "}").otherwise("]")

        def step(s: Column, token: Column) -> Column:
            depth = s["depth"] + F.when(s["quoted"], 0).when(token == opens, 1).when(token == closes, -1).otherwise(0)
            closed = (s["end"] == 0) & (depth == 0) & ~s["quoted"] & (token == closes)
            return F.struct(
                (s["n"] + 1).alias("n"),
                depth.alias("depth"),
                F.when((token == '"') & ~s["escaped"], ~s["quoted"]).otherwise(s["quoted"]).alias("quoted"),
                (s["quoted"] & ~s["escaped"] & (token == "\\")).alias("escaped"),
                F.when(closed, s["n"] + 1).otherwise(s["end"]).alias("end"),
            )

        return F.array_join(F.slice(tokens, F.lit(1), F.aggregate(tokens, start, step)["end"]), "")

    tail = F.regexp_extract(source, r"(?s)[{\[].*", 0)
    found = X.held(F.regexp_extract_all(tail, F.lit(r'[\\"{}\[\]]|[^\\"{}\[\]]+'), F.lit(0)), balanced)
    return X.held(found, lambda f: F.when(F.try_parse_json(f).isNotNull(), f))


@query("documents", sql=r"""
SELECT doc_id, CASE WHEN doc_id % 4 <> 3 THEN md5(to_json(struct_pack(id := doc_id, body := ['say "{" \ ]', text]))) END AS json FROM documents""")  # fmt: skip
def json_in_prose(documents: DataFrame) -> DataFrame:
    """What comes back of JSON put into fences, prose, nothing, or cut short."""
    whole = F.to_json(F.struct(F.col("doc_id").alias("id"), F.array(F.lit('say "{" \\ ]'), F.col("text")).alias("body")))
    kind = F.col("doc_id") % 4
    fenced = F.concat(F.lit('Here [you] are:\n```json\n'), whole, F.lit("\n```\nThat is {all}."))
    noisy = F.when(kind == 0, fenced).when(kind == 1, F.concat(F.lit("Sure: "), whole, F.lit(" and ] more }"))).when(kind == 2, whole).otherwise(F.expr("'x ' || left(text, 5) || ' {\"a\": [1'"))
    return documents.select("doc_id", F.md5(first_json(noisy)).alias("json"))


def with_anchor(prose: Column, anchor: Column, url: Column) -> Column:
    """Prose with a link over the first place, outside links, that has the anchor's words with one to four other signs between; null if none has."""
    words = F.regexp_extract_all(anchor, F.lit("[0-9A-Za-z%$]+"), F.lit(0))
    pattern = F.concat(F.lit("(?i)"), F.array_join(F.transform(words, lambda w: F.replace(w, F.lit("$"), F.lit("[$]"))), "[^0-9A-Za-z]{1,4}"))

    def linked(masked: Column) -> Column:
        before = F.length(F.get(F.split(masked, pattern, 2), F.lit(0)))
        found = F.substring(prose, before + 1, F.length(F.regexp_substr(masked, pattern)))
        rest = F.substring(prose, before + F.length(found) + 1, F.length(prose))
        return F.when((F.size(words) > 0) & F.regexp_like(masked, pattern), F.concat(F.left(prose, before), F.lit("["), found, F.lit("]("), url, F.lit(")"), rest))

    return X.held(X.rewritten(prose, LINK, lambda link: F.repeat(F.lit("\0"), F.length(link))), linked)


@query("conversations", sql=r"""
WITH t AS (SELECT conv_id, turn, text || ' [big cost study](https://a.example/b) ' AS pre, CASE turn % 3 WHEN 0 THEN 'Big, (cost) study' WHEN 1 THEN 'BIG-cost  study' ELSE 'big cost of study' END AS hit, ' and big cost study ' || text AS post FROM conversations)
SELECT conv_id, turn, CASE WHEN turn % 3 < 2 THEN pre || '[' || hit || '](https://c.example/d)' || post ELSE pre || hit || ' and [big cost study](https://c.example/d) ' || substr(post, 21) END AS linked FROM t""")  # fmt: skip
def anchors_laid(conversations: DataFrame) -> DataFrame:
    hit = F.when(F.col("turn") % 3 == 0, "Big, (cost) study").when(F.col("turn") % 3 == 1, "BIG-cost  study").otherwise("big cost of study")
    prose = F.concat(F.col("text"), F.lit(" [big cost study](https://a.example/b) "), hit, F.lit(" and big cost study "), F.col("text"))
    return conversations.select("conv_id", "turn", with_anchor(prose, F.lit("big cost study"), F.lit("https://c.example/d")).alias("linked"))


#: What sections to leave out of an outline are called.
APPENDED = ["See also", "See Also", "Notes", "References", "External links", "External Links", "Bibliography", "Summary", "Appendices", "Appendix"]


def outline_cleaned(outline: Column, topic: Column | None = None) -> Column:
    """Headings of an outline, its bullets as headings one level deeper; text, citations and appended sections out.

    Where a line holds "# " and the topic, what stands before it goes. Of sections on further reading only a
    bare title goes.
    """
    lines = F.transform(F.split(outline, "\n"), _stripped)
    none = F.array().cast("array<string>")

    def step(s: Column, line: Column) -> Column:
        head, bullet = F.startswith(line, F.lit("#")), F.startswith(line, F.lit("-"))
        kept = s["kept"] if topic is None else F.when((topic != "") & F.contains(F.lower(line), F.concat(F.lit("# "), F.lower(topic))), none).otherwise(s["kept"])
        level = F.when(head, F.length(line) - F.length(F.replace(line, F.lit("#"), F.lit("")))).otherwise(s["level"])
        deeper = F.concat(F.repeat(F.lit("#"), level + 1), F.lit(" "), _stripped(F.substring(line, F.lit(2), F.length(line))))
        return F.struct(level.alias("level"), F.when(head, F.concat(kept, F.array(line))).when(bullet, F.concat(kept, F.array(deeper))).otherwise(kept).alias("kept"))

    out = F.array_join(F.aggregate(lines, F.struct(F.lit(0).alias("level"), none.alias("kept")), step)["kept"], "\n")
    for name in APPENDED:
        out = F.regexp_replace(out, rf"(?sd)#[#]? {name}.*?(?=##|$)", "")
    for name in ("Further reading", "Further Reading"):
        out = F.regexp_replace(out, rf"(?d)#[#]? {name}(?=##|$)", "")
    return F.regexp_replace(out, r"(?d)\[.*?\]", "")


def section_cleaned(text: Column) -> Column:
    """A section's paragraphs cut behind their last whole sentence, without summing up and without sections called so."""
    bare = F.filter(F.transform(F.split(text, "\n"), _stripped), lambda p: p != "")
    lines = F.transform(bare, lambda p: F.when(F.startswith(p, F.lit("#")), p).otherwise(X.whole_sentences(p)))

    def step(s: Column, p: Column) -> Column:
        skipped = s["closing"] & ~F.startswith(p, F.lit("#"))
        sums = p.rlike("^(?:Overall|In summary|In conclusion)")
        closing = skipped | (~sums & p.rlike("# (?:Summary|Conclusion)"))
        return F.struct(closing.alias("closing"), F.when(closing | sums, s["kept"]).otherwise(F.concat(s["kept"], F.array(p))).alias("kept"))

    start = F.struct(F.lit(False).alias("closing"), F.array().cast("array<string>").alias("kept"))
    return F.array_join(F.aggregate(lines, start, step)["kept"], "\n\n")


@query("conversations", sql=r"""
SELECT conv_id, turn, '# Top' || chr(10) || '## A ' || turn || chr(10) || '### first' || chr(10) || '## B' || chr(10) || '### second' || chr(10) || '### book' || chr(10) || '### page' AS outline,
  '# Top' || chr(10) || chr(10) || 'One stop. Two ' || turn || '! [2]' || chr(10) || chr(10) || '# Next' || chr(10) || chr(10) || 'Last.' AS section FROM conversations""")  # fmt: skip
def drafts_cleaned(conversations: DataFrame) -> DataFrame:
    """Outlines and sections with noise of each kind added and taken off again."""
    n = F.col("turn").cast("string")
    outline = F.concat(F.lit("intro\n# Old\n# Top\n prose [1]\n## A "), n, F.lit("[4]\n- first\n## B\n-second [c]\n## References\n- book\n- page"))
    section = F.concat(F.lit("# Top\n\nOne stop. Two "), n, F.lit("! [3][2][3] and cut of\nOverall, fine.\n# Summary\nAll of it.\n\n# Next\nLast."))
    trimmed = F.regexp_replace(outline_cleaned(outline, F.lit("top")), r"(?m)[ \t]+$|\n+\z", "")
    return conversations.select("conv_id", "turn", trimmed.alias("outline"), section_cleaned(section).alias("section"))


def _lines(text: Column) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), _stripped), lambda s: s != "")


def average_sentence(text: Column) -> Column:
    """Words in a sentence of prose on average, to one decimal: headings, rows of tables and items left out, pieces of one word too."""
    prose = F.filter(_lines(X.without_marks(text)), lambda s: ~s.rlike(r"^[#|]") & ~s.rlike(ITEM))
    n = F.transform(X.sentences(F.array_join(prose, " "), 2), X.word_count)
    total = F.aggregate(n, F.lit(0), lambda a, b: a + b)
    return F.when(F.size(n) > 0, F.bround(total / F.size(n), 1)).otherwise(0.0)


def edit_faults(before: Column, after: Column) -> Column:
    """What an edit broke, in order: words, lost, made, tags, links, headings, structure, longer, chopped; empty if nothing."""
    figures = lambda t: F.array_distinct(F.transform(F.regexp_extract_all(t, F.lit(r"\d[\d,.]*"), F.lit(0)), lambda n: F.rtrim(n, F.lit(",."))))
    links = lambda t: F.array_sort(F.regexp_extract_all(t, F.lit(LINK), F.lit(0)))
    heads = lambda t: F.filter(_lines(t), lambda s: F.startswith(s, F.lit("#")))
    items = lambda t: F.filter(_lines(t), lambda s: F.startswith(s, F.lit("|")) | s.rlike(ITEM))
    before, after = F.coalesce(before, F.lit("")), F.coalesce(after, F.lit(""))
    n, m = X.word_count(X.without_marks(before)), X.word_count(X.without_marks(after))
    was, now = average_sentence(before), average_sentence(after)
    rules = [
        ("words", F.abs(m - n) > F.greatest(F.lit(8.0), F.bround(n * 0.05))),
        ("lost", F.size(F.array_except(figures(before), figures(after))) > 0),
        ("made", F.size(F.array_except(figures(after), figures(before))) > 0),
        ("tags", F.array_sort(X.tag_ids(before)) != F.array_sort(X.tag_ids(after))),
        ("links", links(before) != links(after)),
        ("headings", heads(before) != heads(after)),
        ("structure", items(before) != items(after)),
        ("longer", now > was + 0.5),
        ("chopped", (n >= 60) & (now < 8.5)),
    ]
    return F.filter(F.array(*[F.when(broken, F.lit(name)) for name, broken in rules]), lambda r: r.isNotNull())


_STRIP = r"list_filter(list_transform(string_split({}, chr(10)), lambda s: regexp_replace(s, '^\s+|\s+$', '', 'g')), lambda s: s <> '')"
_EDITED = """CASE turn % 8 WHEN 0 THEN b WHEN 1 THEN replace(b, '1,200', '1,300') WHEN 2 THEN replace(b, '[c1]', '[c2]') WHEN 3 THEN replace(b, 'x.example/y', 'x.example/z')
 WHEN 4 THEN replace(b, '# Head', '# Heads') WHEN 5 THEN replace(b, '- item 12', '- item twelve') WHEN 6 THEN b || repeat(' more words here', 10) ELSE replace(b, '. ', ', ') END"""
_MADE = "'# Head' || chr(10) || text || chr(10) || '- item 12' || chr(10) || '[a link](https://x.example/y) cost 1,200 at most [c1].'"


@query("conversations", sql=rf"""
WITH p AS (SELECT conv_id, turn, {_MADE} AS b FROM conversations), v AS (SELECT conv_id, turn, TRUE AS first, b AS t FROM p UNION ALL SELECT conv_id, turn, FALSE, {_EDITED} FROM p),
l AS (SELECT conv_id, turn, first, t, regexp_replace(regexp_replace(t, '\[c\d+\]', '', 'g'), '\[([^\]]*)\]\([^)\s]*\)', '\1', 'g') AS bare, {_STRIP.format("t")} AS lines FROM v),
s AS (SELECT *, list_filter(list_transform(string_split(regexp_replace(array_to_string(list_filter({_STRIP.format("bare")}, lambda s: NOT regexp_matches(s, '^([#|]|[-*+] |\d+\.\s)')), ' '), '([.!?])\s+', '\1␞', 'g'), '␞'),
  lambda s: {_WORDS.format("s")}), lambda n: n > 1) AS sizes FROM l),
g AS (SELECT conv_id, turn, first, {_WORDS.format("bare")} AS n, list_distinct(list_transform(regexp_extract_all(t, '\d[\d,.]*'), lambda x: rtrim(x, ',.'))) AS figures, list_sort(regexp_extract_all(t, '\[c(\d+)\]', 1)) AS tags,
  list_sort(regexp_extract_all(t, '{LINK}')) AS links, list_filter(lines, lambda s: starts_with(s, '#')) AS heads, list_filter(lines, lambda s: starts_with(s, '|') OR regexp_matches(s, '^([-*+] |\d+\.\s)')) AS items,
  CASE WHEN len(sizes) > 0 THEN round_even(list_sum(sizes)::DOUBLE / len(sizes), 1) ELSE 0 END AS mean FROM s)
SELECT conv_id, turn, array_to_string(list_filter([CASE WHEN abs(b.n - a.n) > greatest(8, round_even(a.n * 0.05::DOUBLE, 0)) THEN 'words' END, CASE WHEN len(list_filter(a.figures, lambda x: NOT list_contains(b.figures, x))) > 0 THEN 'lost' END,
  CASE WHEN len(list_filter(b.figures, lambda x: NOT list_contains(a.figures, x))) > 0 THEN 'made' END, CASE WHEN a.tags <> b.tags THEN 'tags' END, CASE WHEN a.links <> b.links THEN 'links' END, CASE WHEN a.heads <> b.heads THEN 'headings' END,
  CASE WHEN a.items <> b.items THEN 'structure' END, CASE WHEN b.mean > a.mean + 0.5 THEN 'longer' END, CASE WHEN a.n >= 60 AND b.mean < 8.5 THEN 'chopped' END], lambda x: x IS NOT NULL), ' ') AS faults
FROM g a JOIN g b USING (conv_id, turn) WHERE a.first AND NOT b.first""")  # fmt: skip
def edits_checked(conversations: DataFrame) -> DataFrame:
    """Turns with a heading, an item, a link and a tag, each edited in one of eight ways."""
    b = F.col("b")
    swap = lambda old, new: F.replace(b, F.lit(old), F.lit(new))
    edits = [b, swap("1,200", "1,300"), swap("[c1]", "[c2]"), swap("x.example/y", "x.example/z"), swap("# Head", "# Heads"), swap("- item 12", "- item twelve"), F.concat(b, F.repeat(F.lit(" more words here"), 10)), swap(". ", ", ")]
    made = F.concat(F.lit("# Head\n"), "text", F.lit("\n- item 12\n[a link](https://x.example/y) cost 1,200 at most [c1]."))
    after = F.when(F.lit(False), b)
    for i, edit in enumerate(edits):
        after = after.when(F.col("turn") % 8 == i, edit)
    pairs = conversations.select("conv_id", "turn", made.alias("b")).withColumn("a", after)
    return pairs.select("conv_id", "turn", F.array_join(edit_faults(b, F.col("a")), " ").alias("faults"))


@query("documents", sql=rf"""
WITH b AS (SELECT doc_id, unnest(string_split(text || chr(10) || chr(10) || '- a b' || chr(10) || '2) c d' || chr(10) || chr(10) || '| x | y |' || chr(10) || '|--|' || chr(10) || chr(10) || '1. one' || chr(10) || 'more here', chr(10) || chr(10))) AS block,
  generate_subscripts(string_split(text || chr(10) || chr(10) || '- a b' || chr(10) || '2) c d' || chr(10) || chr(10) || '| x | y |' || chr(10) || '|--|' || chr(10) || chr(10) || '1. one' || chr(10) || 'more here', chr(10) || chr(10)), 1) - 1 AS pos FROM documents),
l AS (SELECT doc_id, pos, list_filter({_STRIP.format("block")}, lambda s: NOT regexp_matches(s, '^([#|]|[-| :]*$)')) AS lines FROM b)
SELECT doc_id, pos, len(list_filter(lines, lambda s: regexp_matches(s, '^([-*+]\s|\d+[.)]\s)'))) >= greatest(2, len(lines) // 2) AS is_list, {_WORDS.format("array_to_string(lines, ' ')")} AS words FROM l WHERE len(lines) > 0""")  # fmt: skip
def list_aware_paragraphs(documents: DataFrame) -> DataFrame:
    """Blocks between blank lines, headings and tables out, and whether items make up half of one, two at least."""
    text = F.concat("text", F.lit("\n\n- a b\n2) c d\n\n| x | y |\n|--|\n\n1. one\nmore here"))
    blocks = documents.select("doc_id", F.posexplode(F.split(text, "\n\n")).alias("pos", "block"))
    held = blocks.select("doc_id", "pos", F.filter(_lines(F.col("block")), lambda s: ~s.rlike(r"^([#|]|[-| :]*$)")).alias("lines")).where(F.size("lines") > 0)
    items = F.size(F.filter("lines", lambda s: s.rlike(r"^([-*+]\s|\d+[.)]\s)")))
    most = F.greatest(F.lit(2), F.floor(F.size("lines") / 2))
    return held.select("doc_id", "pos", (items >= most).alias("is_list"), X.word_count(F.array_join("lines", " ")).cast("long").alias("words"))


_KIN = r"' ' || array_to_string(list_transform(regexp_extract_all(lower({}), '[a-z0-9]+'), lambda w: regexp_replace(w, 's$', '')), ' ') || ' '"


@query("part", sql=rf"""
WITH h AS (SELECT p_brand || ' ' || split_part(p_name, ' ', 1) AS phrase, CASE p_size % 5 WHEN 0 THEN p_name WHEN 1 THEN upper(replace(p_brand, '#', '-')) || ' ' || split_part(p_name, ' ', 1) || 's now' ELSE p_brand || ' ' || p_name END AS after FROM part)
SELECT phrase, count(*) AS uses, count(*) FILTER (WHERE contains({_KIN.format("after")}, {_KIN.format("phrase")})) AS survive, count(*) FILTER (WHERE contains({_KIN.format("after")}, {_KIN.format("phrase")})) < 2 AS refused
FROM h GROUP BY 1 HAVING count(*) > 2""")  # fmt: skip
def phrase_floor(part: DataFrame, cap: int = 2) -> DataFrame:
    """Phrases in more headings than the cap, how many still hold one after an edit, and whether the edit is refused as too few do."""
    first = F.get(F.split("p_name", " "), F.lit(0))
    kind = F.col("p_size") % 5
    after = F.when(kind == 0, F.col("p_name")).when(kind == 1, F.concat(F.upper(F.replace("p_brand", F.lit("#"), F.lit("-"))), F.lit(" "), first, F.lit("s now"))).otherwise(F.concat("p_brand", F.lit(" "), "p_name"))
    flat = lambda t: F.concat(F.lit(" "), F.array_join(F.transform(F.split(X.flat(t), " "), lambda w: F.regexp_replace(w, "s$", "")), " "), F.lit(" "))
    phrase = F.concat("p_brand", F.lit(" "), first)
    held = part.select(phrase.alias("phrase"), F.contains(flat(after), flat(phrase)).alias("held"))
    return held.groupBy("phrase").agg(F.count("*").alias("uses"), F.count_if("held").alias("survive")).where(F.col("uses") > cap).withColumn("refused", F.col("survive") < cap)


@query("documents", sql="""
WITH c AS (SELECT doc_id, unnest(range(0, CAST(ceil(greatest(length(text) - 4800, 0) / 4200.0) AS BIGINT) * 4200 + 1, 4200)) AS start FROM documents)
SELECT doc_id, start, (row_number() OVER (ORDER BY doc_id, start) - 1) // 64 AS batch FROM c""")  # fmt: skip
def chunk_batches(documents: DataFrame, size: int = 64) -> DataFrame:
    """Chunks in order and the batch that each is sent in."""
    cut = documents.select("doc_id", F.explode(X.chunk_starts(F.col("text"))).alias("start")).withColumn("start", F.col("start").cast("long"))
    return numbered(cut, [], ["doc_id", "start"], "n").select("doc_id", "start", F.floor((F.col("n") - 1) / size).cast("long").alias("batch"))
