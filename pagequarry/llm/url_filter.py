"""URL filter: rules decide what they fit, and two character language models what no rule fits.

The URLs that rules allow and those that they block each train a Markov model of variable order: the chance of a
character after the 4 before it, mixed with the chance after 3, 2, 1 and none (Witten and Bell's weights: a context
that goes on in many ways trusts its shorter ones more), down to one in 256. A URL's score is the mean over its
characters and its end of the difference of both log-likelihoods, so long URLs weigh as short ones. Where to cut is
calibrated on labelled URLs that trained neither model: the cut with the most blocked ones below and the fewest
allowed ones, of equally good ones that nearest to 0.

All of it is built-in functions. A URL counts once however many pages have it. What depends on characters is
worked out for each distinct run of 5, never for each URL, and met with the URLs' runs in one join; the runs of
one key are split by adaptive execution, and both models grow with the number of different runs, not of URLs. Long
URLs are read in pieces of 64 characters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

#: Characters in a run: the one that is judged and those before it.
RUN = 5
PIECE = 64
#: Chance of any character where nothing is known.
ANY = 1 / 256
START, END = "\u0002", "\u0003"
#: Cuts are tried at multiples of 1 / BINS, up to SPREAD on both sides of 0.
BINS, SPREAD = 256, 8
#: Labelled URLs are kept from training, for the cut, if their md5 begins so.
HELD = ("0", "1", "2", "3")
#: (verdict, host and its subdomains, what the path starts with)
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def after_scheme(url: Column) -> Column:
    """What follows the first ://, nothing if there is none."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(after_scheme(url), "^[^/?#]*", 0), CAPITALS, SMALL)


def path_of(url: Column) -> Column:
    return F.regexp_extract(after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def by_rules(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else null."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for told, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, told).otherwise(verdict)
    return rule, verdict


def runs_of(url: Column) -> Column:
    """For each character of a URL and its end: itself and up to RUN - 1 characters before it. An array of arrays, by piece."""
    pieces = F.regexp_extract_all(F.concat(F.lit(START), F.coalesce(url, F.lit("")), F.lit(END)), F.lit(f"(?s)(.{{1,{PIECE}}})"))
    before = F.concat(F.array(F.lit("")), F.transform(pieces, lambda p: F.right(p, F.lit(RUN - 1))))
    whole = F.zip_with(pieces, F.slice(before, 1, F.size(pieces)), lambda p, b: F.struct(F.concat(b, p).alias("text"), F.greatest(F.length(b) + 1, F.lit(2)).alias("from")))

    def cut(piece: Column) -> Column:
        text, at = piece["text"], piece["from"]
        return F.when(at <= F.length(text), F.transform(F.sequence(at, F.length(text)), lambda j: F.substr(text, F.greatest(j - (RUN - 1), F.lit(1)), F.least(j, F.lit(RUN)))))

    return F.transform(whole, cut)


def _model(fit: DataFrame) -> DataFrame:
    """What is known of each string, as a run's end (n) and as what stands before a character (all, kinds), by class."""
    runs = fit.groupBy("run").agg(*[F.count_if(F.col("label") == c).alias(f"n_{c}") for c in ("allow", "block")])
    ends = runs.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("run")), lambda k: F.right(F.col("run"), k))).alias("s"), "n_allow", "n_block")
    counts = ends.groupBy("s").agg(F.sum("n_allow").alias("n_allow"), F.sum("n_block").alias("n_block"))
    sides = F.array(
        F.struct("s", *[F.col(f"n_{c}").alias(f"n_{c}") for c in ("allow", "block")], *[F.lit(0).cast("long").alias(f"{x}_{c}") for c in ("allow", "block") for x in ("all", "kinds")]),
        F.struct(F.expr("left(s, length(s) - 1)").alias("s"), *[F.lit(0).cast("long").alias(f"n_{c}") for c in ("allow", "block")], *[y for c in ("allow", "block") for y in (F.col(f"n_{c}").alias(f"all_{c}"), (F.col(f"n_{c}") > 0).cast("long").alias(f"kinds_{c}"))]),
    )
    both = counts.select(F.inline(sides))
    return both.groupBy("s").agg(*[F.sum(c).alias(c) for c in both.columns[1:]])


def _gains(seen: DataFrame, model: DataFrame) -> DataFrame:
    """(run, gain): the difference of the log-chances of each run's last character under both models."""
    ks = range(1, RUN + 1)
    keys = F.transform(F.sequence(F.lit(1), F.length("run")), lambda k: F.array(F.struct(k.alias("k"), F.lit(True).alias("end"), F.right(F.col("run"), k).alias("s")), F.struct(k.alias("k"), F.lit(False).alias("end"), F.substr(F.col("run"), F.length("run") - k + 1, k - 1).alias("s"))))
    asked = seen.select("run", F.inline(F.flatten(keys))).where("end or k > 1")
    known = asked.join(model, "s")
    facts = [F.sum(F.when((F.col("k") == k) & (F.col("end") if of == "n" else ~F.col("end")), F.col(f"{of}_{c}")).otherwise(0)).alias(f"{of}_{c}_{k}") for k in ks for c in ("allow", "block") for of in (("n",) if k == 1 else ("n", "all", "kinds"))]
    first = model.where("s = ''").agg(*[F.coalesce(F.sum(f"{of}_{c}"), F.lit(0)).alias(f"{of}_{c}_1") for c in ("allow", "block") for of in ("all", "kinds")])
    told = seen.join(known.groupBy("run").agg(*facts), "run", "left").join(F.broadcast(first))

    def chance(c: str) -> Column:
        p = F.lit(ANY)
        for k in ks:
            n, total, kinds = (F.coalesce(F.col(f"{of}_{c}_{k}"), F.lit(0)) for of in ("n", "all", "kinds"))
            p = F.when(total > 0, (n + kinds * p) / (total + kinds)).otherwise(p)
        return p

    return told.select("run", (F.log(chance("allow")) - F.log(chance("block"))).alias("gain"))


def _cut(scored: DataFrame) -> DataFrame:
    """One row: the least score that is allowed. Windows run over at most 2 * BINS * SPREAD + 2 bins."""
    at = F.greatest(F.least(F.floor(F.col("score") * BINS), F.lit(BINS * SPREAD)), F.lit(-BINS * SPREAD))
    bins = scored.groupBy(at.alias("bin")).agg(F.count_if(F.col("label") == "allow").alias("a"), F.count_if(F.col("label") == "block").alias("b"))
    edges = bins.select("bin", "a", "b").unionByName(bins.select((F.col("bin") + 1).alias("bin"), F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))).groupBy("bin").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    below = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    part = lambda c: F.coalesce(F.sum(c).over(below), F.lit(0)) / F.sum(c).over(whole)
    good = edges.select("bin", F.round(part("b") - part("a"), 9).alias("good")).where("good is not null")
    best = good.agg(F.max_by("bin", F.struct("good", -F.abs("bin"), "bin")).alias("bin"))
    return best.select((F.coalesce("bin", F.lit(0)) / BINS).alias("cut"))


def url_filter(pages: DataFrame, rules=RULES, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, score): allow or block for each row of pages.

    A rule (verdict, host, start of path) fits its host and all subdomains; the longest wins; without one the models
    judge the whole URL. A null URL is judged as an empty one; a very long one whole; pages that share a URL alike;
    without labelled URLs of both kinds to calibrate on the cut is at 0, and a score on the cut is allowed; an empty
    table gives no rows; repeated rows and null ids stay; further columns, whatever their names, are ignored.
    """
    link = F.col(url)
    rule, verdict = by_rules(F.col("host"), F.col("path"), rules)
    each = pages.select(F.col(page_id).alias("page_id"), link.alias("url"), host_of(link).alias("host"), path_of(link).alias("path"))
    ruled = each.withColumn("host", F.coalesce("host", F.lit(""))).withColumn("path", F.coalesce("path", F.lit(""))).select("page_id", F.coalesce("url", F.lit("")).alias("url"), "host", "path", rule.alias("rule"), verdict.alias("label"))
    urls = ruled.select("url", "label").distinct()
    key = (F.xxhash64("url").alias("k1"), F.xxhash64("url", F.lit(1)).alias("k2"))
    held = F.substr(F.md5("url"), F.lit(1), F.lit(1)).isin(*HELD)
    runs = urls.select(*key, "label", held.alias("held"), F.explode(runs_of(F.col("url"))).alias("piece")).select("k1", "k2", "label", "held", F.explode("piece").alias("run"))
    model = _model(runs.where("label is not null and not held").select("label", "run"))
    gains = written(_gains(runs.select("run").distinct(), model))
    sums = runs.join(gains, "run").groupBy("k1", "k2").agg(F.round(F.avg("gain"), 9).alias("score"), F.first("label").alias("label"), F.first("held").alias("held"))
    scores = written(sums)
    cut = _cut(scores.where("held and label is not null"))
    judged = ruled.select("*", *key).join(scores.select("k1", "k2", "score"), ["k1", "k2"]).join(F.broadcast(cut))
    told = F.coalesce("label", F.when(F.col("score") >= F.col("cut"), "allow").otherwise("block"))
    return judged.select("page_id", "host", "path", "rule", told.alias("verdict"), "score")


def _sql() -> str:
    """The same in DuckDB's SQL: counts of all ends of runs, their chances from short to long, scores, the cut."""
    ruled = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    fits = [(f"(host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}')", h + p, told) for told, h, p in ruled]
    case = lambda i: "case " + " ".join(f"when {f[0]} then '{f[i]}'" for f in fits) + " end"
    pick = lambda c, k: ", ".join(f"coalesce(max(case when k = {k} then {of}_{c} end), 0) as {of}_{c}_{k}" for of in ("n", "total", "kinds"))

    def chance(c: str) -> str:
        p = str(ANY)
        for k in range(1, RUN + 1):
            p = f"(case when total_{c}_{k} > 0 then (n_{c}_{k} + kinds_{c}_{k} * {p}) / (total_{c}_{k} + kinds_{c}_{k})::double else {p} end)"
        return p

    return f"""
with links as (select page_id, coalesce(url, '') as url, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
     parts as (select page_id, url, translate(regexp_extract(rest, '^[^/?#]*'), '{CAPITALS}', '{SMALL}') as host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from links),
     ruled as (select *, {case(1)} as rule, {case(2)} as label from parts),
     urls as (select distinct url, label, md5(url)[1] in {HELD} as held, chr(2) || url || chr(3) as t from ruled),
     runs as (select url, label, held, substr(t, greatest(j - {RUN - 1}, 1), least(j, {RUN})) as run from (select *, unnest(range(2, length(t) + 1)) as j from urls)),
     ends as (select right(run, k) as s, label from (select *, unnest(range(1, length(run) + 1)) as k from runs where label is not null and not held)),
     counts as (select s, left(s, length(s) - 1) as c, count(*) filter (label = 'allow') as n_allow, count(*) filter (label = 'block') as n_block from ends group by s),
     contexts as (select c, sum(n_allow)::bigint as total_allow, sum(n_block)::bigint as total_block, count(*) filter (n_allow > 0) as kinds_allow, count(*) filter (n_block > 0) as kinds_block from counts group by c),
     asked as (select run, unnest(range(1, length(run) + 1)) as k from (select distinct run from runs)),
     facts as (select run, {", ".join(pick(c, k) for c in ("allow", "block") for k in range(1, RUN + 1))}
               from asked left join counts on s = right(run, k) left join contexts x on x.c = left(right(run, k), k - 1) group by run),
     gains as (select run, ln({chance("allow")}) - ln({chance("block")}) as gain from facts),
     scores as (select url, any_value(label) as label, any_value(held) as held, round(avg(gain), 9) as score from runs join gains using (run) group by url),
     bins as (select greatest(least(floor(score * {BINS}), {BINS * SPREAD}), {-BINS * SPREAD})::bigint as bin, count(*) filter (label = 'allow') as a, count(*) filter (label = 'block') as b
              from scores where held and label is not null group by 1),
     edges as (select bin, sum(a) as a, sum(b) as b from (from bins union all select bin + 1, 0, 0 from bins) group by bin),
     goods as (select bin, round(coalesce(sum(b) over w, 0) / nullif(sum(b) over (), 0) - coalesce(sum(a) over w, 0) / nullif(sum(a) over (), 0), 9) as good
               from edges window w as (order by bin rows between unbounded preceding and 1 preceding)),
     cut as (select coalesce((select bin from goods where good is not null order by good desc, abs(bin), bin desc limit 1), 0) / {BINS}.0 as cut)
select page_id, host, path, rule, coalesce(ruled.label, case when score >= cut then 'allow' else 'block' end) as verdict
from ruled join scores using (url), cut
"""


SQL = _sql()
