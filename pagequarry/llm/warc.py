"""WARC records and Merkle fixity audits.

Pages become WARC records; equal records are stored once with a count. A record's key is a hash of its id
and its digest; the key says in which archive the record lies, and records lie in order of their keys, so
they have offsets. The first two hex digits of the rest of the key name one of 256 offset ranges of an archive,
the first digit one of 16 branches above. A range's node hashes the digests, lengths, offsets (from
the start of the range) and copies of its records, a branch's node its ranges, a root its branches. An audit holds
the roots of two replicas, each a table of pages, against each other, goes down only below nodes that
differ, and joins records only in ranges that differ: those that one replica lacks are missing or added,
and a missing and an added one of the same id are one that was altered. A record that is lost, added or of
another length moves the offsets of later ranges, not their hashes. Only digests are shuffled, never
texts, and no group holds more than an archive of about ARCHIVE records. All of it is built-in functions.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

ARCHIVE = 1024


def record(page_id: Column, url: Column, html: Column) -> Column:
    """The text of a WARC response record; null columns are empty."""
    page, link, body = (F.coalesce(c.cast("string"), F.lit("")) for c in (page_id, url, html))
    head = F.concat(F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"), page, F.lit(">\r\nWARC-Target-URI: "), link)
    return F.concat(head, F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))


def manifest(pages: DataFrame, archives: int | None = None, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, digest, length, copies, archive, range, position, offset, start), one row for each different record.

    archives: how many there are, about ARCHIVE records to each by default. start: the offset within its range.
    """
    text = record(F.col(page_id), F.col(url), F.col(html))
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.sha2(text, 256).alias("digest"), F.octet_length(text).cast("long").alias("length"))
    rows = written(rows.groupBy("page_id", "digest", "length").agg(F.count("*").alias("copies")))
    n = archives or max(1, -(-rows.count() // ARCHIVE))
    key = F.md5(F.concat(F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit("|"), F.col("digest")))
    rows = rows.withColumn("key", key).withColumn("archive", F.pmod(F.conv(F.substring("key", 1, 8), 16, 10).cast("long"), F.lit(n)))
    order = Window.partitionBy("archive").orderBy(F.substring("key", 9, 24), "key", F.col("page_id").asc_nulls_first(), "digest")
    rows = rows.select(
        "page_id", "digest", "length", "copies", "archive", F.substring("key", 9, 2).alias("range"), (F.row_number().over(order) - 1).cast("long").alias("position"),
        (F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("length")).alias("offset"),
    )
    return rows.withColumn("start", F.col("offset") - F.min("offset").over(Window.partitionBy("archive", "range")))


def ranges(leaves: DataFrame) -> DataFrame:
    """(archive, range, hash): the lowest nodes of the trees of a manifest."""
    parts = F.array_sort(F.collect_list(F.struct("position", F.concat_ws(":", "start", "length", "copies", "digest").alias("said"))))
    return leaves.groupBy("archive", "range").agg(F.sha2(F.array_join(F.transform(parts, lambda x: x["said"]), ","), 256).alias("hash"))


def above(nodes: DataFrame, below: str, *by: str) -> DataFrame:
    """The nodes over some others: (by, hash), their names and hashes joined in order."""
    parts = F.array_sort(F.collect_list(F.concat_ws(":", below, "hash")))
    return nodes.groupBy(*by).agg(F.sha2(F.array_join(parts, ","), 256).alias("hash"))


def levels(leaves: DataFrame) -> list[DataFrame]:
    """The trees from the ranges up to the roots."""
    low = written(ranges(leaves))
    middle = above(low.withColumn("branch", F.substring("range", 1, 1)), "range", "archive", "branch")
    return [low, middle, above(middle, "branch", "archive")]


def unlike(one: DataFrame, other: DataFrame, *by: str) -> DataFrame:
    """The nodes that differ between two replicas, or that only one has."""
    both = one.join(other.withColumnRenamed("hash", "held"), list(by), "full_outer")
    return both.where(~F.col("hash").eqNullSafe(F.col("held"))).select(*by)


def damaged(one: list[DataFrame], other: list[DataFrame]) -> DataFrame:
    """(archive, range): the ranges that differ, found from the roots down."""
    roots = unlike(one[2], other[2], "archive")
    held = [x[1].join(roots, "archive", "left_semi") for x in (one, other)]
    branches = unlike(*held, "archive", "branch")
    held = [x[0].withColumn("branch", F.substring("range", 1, 1)).join(branches, ["archive", "branch"], "left_semi") for x in (one, other)]
    return unlike(*[x.drop("branch") for x in held], "archive", "range")


def audit(pages: DataFrame, replica: DataFrame, **columns: str) -> DataFrame:
    """Holds a replica, a table of pages like the first, against pages.

    Returns the manifest of pages, with `root` (of its archive) and `state`: intact, altered (the replica
    has another record of this id in its place), missing, or fewer or more (the replica has it in fewer or more
    copies); and the records that only the replica has, as added, with null positions, offsets and roots. Null
    columns are empty texts in a record; null ids are ids like any other; very long texts are hashed like others; an empty table gives
    no rows but those added; other columns, whatever their names, are ignored.
    """
    mine = written(manifest(pages, None, **columns))
    count = (mine.agg(F.count("*")).first()[0] or 0)
    theirs = written(manifest(replica, max(1, -(-count // ARCHIVE)), **columns))
    one, other = levels(mine), levels(theirs)
    bad = written(damaged(one, other))
    record_of = ["archive", "range", "page_id", "digest"]
    here, there = (x.select(*record_of, "length", "copies").join(bad, ["archive", "range"], "left_semi") for x in (mine, theirs))
    same = lambda a, b: (a.archive == b.archive) & (a.range == b.range) & a.page_id.eqNullSafe(b.page_id) & (a.digest == b.digest)
    lost = written(here.join(there, same(here, there), "left_anti"))
    found = written(there.join(here, same(there, here), "left_anti"))
    swapped = found.select(F.col("page_id").alias("id")).distinct().withColumn("altered", F.lit(True))
    gone = lost.join(swapped, lost.page_id.eqNullSafe(swapped.id), "left").select("archive", F.col("digest").alias("of"), F.col("page_id").alias("id"), F.when(F.col("altered"), "altered").otherwise("missing").alias("found"))
    uneven = here.join(there, same(here, there)).where(here.copies != there.copies).select(here.archive, here.digest.alias("of"), here.page_id.alias("id"), F.when(there.copies < here.copies, "fewer").otherwise("more").alias("found"))
    gone = written(gone.union(uneven))
    roots = one[2].select(F.col("archive").alias("a"), F.col("hash").alias("root"))
    out = mine.join(gone, (mine.archive == gone.archive) & (mine.digest == gone.of) & mine.page_id.eqNullSafe(gone.id), "left").drop(gone.archive).join(roots, F.col("archive") == F.col("a"), "left")
    state = F.coalesce("found", F.lit("intact"))
    names = ["page_id", "archive", "position", "offset", "length", "copies", "digest", "root", "state"]
    out = out.withColumn("state", state).select(names)
    known = lost.select(F.col("page_id").alias("id")).distinct()
    added = found.join(known, found.page_id.eqNullSafe(known.id), "left_anti")
    nothing = F.lit(None).cast("long")
    return out.union(added.select("page_id", "archive", nothing, nothing, "length", "copies", "digest", F.lit(None).cast("string"), F.lit("added")))


def archives(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(archive, content): the bytes of each archive, its records in order of their offsets; about ARCHIVE pages are one task's text."""
    where = manifest(pages, None, page_id, url, html).select("digest", "archive", "position")
    text = record(F.col(page_id), F.col(url), F.col(html))
    texts = pages.select(text.alias("text"), F.sha2(text, 256).alias("digest")).dropDuplicates(["digest"])
    content = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "text"))), lambda x: x["text"]), "")
    return where.join(texts, "digest").groupBy("archive").agg(F.encode(content, "UTF-8").alias("content"))


def parse(content: bytes) -> Iterator[tuple[int, int, dict[str, str] | None, bytes]]:
    """(offset, length, headers, body) of each record of an archive.

    Header names are lower-cased. Bytes that are no whole record (junk between records, a header without a
    length, a body that ends early) come back too, up to the next record, with headers None.
    """
    at, size = 0, len(content)
    while at < size:
        end = content.find(b"\r\n\r\n", at) if content.startswith(b"WARC/1.", at) else -1
        lines = content[at:end].decode("utf-8", "replace").split("\r\n")[1:] if end >= 0 else []
        headers = {k.strip().lower(): v.strip() for k, v in (line.split(":", 1) for line in lines if ":" in line)}
        told = headers.get("content-length", "")
        stop = end + 4 + int(told) if re.fullmatch(r"\d{1,18}", told) else -1
        if end >= 0 and stop >= 0 and content.startswith(b"\r\n\r\n", stop):
            yield at, stop + 4 - at, headers, content[end + 4 : stop]
            at = stop + 4
            continue
        found = content.find(b"WARC/1.", at + 1)
        after = found if found >= 0 else size
        yield at, after - at, None, content[at:after]
        at = after


def read_archives(table: DataFrame, content: str = "content") -> DataFrame:
    """(offset, length, record_id, url, html, whole) of all records of archives of bytes, such as Spark's binaryFile source reads.

    Stretches that are no record are rows too, with whole false and null id, URL and html.
    """
    schema = pa.schema([("offset", pa.int64()), ("length", pa.int64()), ("record_id", pa.string()), ("url", pa.string()), ("html", pa.string()), ("whole", pa.bool_())])

    def row(at, n, h, body):
        return (at, n, h.get("warc-record-id"), h.get("warc-target-uri"), body.decode("utf-8", "replace"), True) if h is not None else (at, n, None, None, None, False)

    def each(batches):
        for batch in batches:
            rows = [row(*r) for raw in batch.column(0).to_pylist() if raw for r in parse(raw)]
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(schema), schema)], schema=schema)

    return table.select(content).mapInArrow(each, "offset long, length long, record_id string, url string, html string, whole boolean")


def query_audit(pages: DataFrame) -> DataFrame:
    """Audits pages against a replica of its own.

    In the replica, pages whose record's digest ends in 00 end in other bytes, those in 01 are left out,
    those in 02 stand a second time, under an id below zero, and those in 03 under their own.
    """
    sign = F.right(F.sha2(record(F.col("page_id"), F.col("url"), F.col("html")), 256), F.lit(2))
    held = pages.select("page_id", "url", "html", sign.alias("sign"))
    kept = held.where("sign != '01'").select("page_id", "url", F.when(F.col("sign") == "00", F.concat(F.coalesce("html", F.lit("")), F.lit("####"))).otherwise(F.col("html")).alias("html"))
    twice = held.where("sign = '02'").select((-1 - F.col("page_id")).alias("page_id"), "url", "html")
    again = held.where("sign = '03'").select("page_id", "url", "html")
    return audit(pages.select("page_id", "url", "html"), kept.union(twice).union(again))


def _sql() -> str:
    line = "chr(13) || chr(10)"
    text = f"""'WARC/1.1' || {line} || 'WARC-Type: response' || {line} || 'WARC-Record-ID: <urn:page:' || coalesce(page_id::VARCHAR, '') || '>' || {line} || 'WARC-Target-URI: '
  || coalesce(url, '') || {line} || 'Content-Type: text/html' || {line} || 'Content-Length: ' || strlen(coalesce(html, '')) || {line} || {line} || coalesce(html, '') || {line} || {line}"""
    return f"""
WITH p AS (SELECT page_id, url, html, sha256({text}) AS digest, strlen({text})::BIGINT AS length FROM pages),
d AS (SELECT page_id, digest, length, count(*) AS copies FROM p GROUP BY ALL),
n AS (SELECT greatest(1, CAST(ceil(count(*) / {ARCHIVE}.0) AS BIGINT)) AS n FROM d),
k AS (SELECT d.*, md5(coalesce(page_id::VARCHAR, '') || '|' || digest) AS key FROM d),
a AS (SELECT k.*, ('0x' || substr(key, 1, 8))::BIGINT % n.n AS archive, substr(key, 9, 2) AS r FROM k CROSS JOIN n),
l AS (SELECT *, row_number() OVER w - 1 AS position, sum(length) OVER w - length AS "offset" FROM a WINDOW w AS (PARTITION BY archive ORDER BY substr(key, 9, 24), key, page_id NULLS FIRST, digest ROWS UNBOUNDED PRECEDING)),
s AS (SELECT *, "offset" - min("offset") OVER (PARTITION BY archive, r) AS start FROM l),
t0 AS (SELECT archive, r, sha256(string_agg(start::BIGINT || ':' || length || ':' || copies || ':' || digest, ',' ORDER BY position)) AS hash FROM s GROUP BY 1, 2),
t1 AS (SELECT archive, substr(r, 1, 1) AS b, sha256(string_agg(r || ':' || hash, ',' ORDER BY r)) AS hash FROM t0 GROUP BY 1, 2),
t2 AS (SELECT archive, sha256(string_agg(b || ':' || hash, ',' ORDER BY b)) AS root FROM t1 GROUP BY 1),
e AS (SELECT -1 - page_id AS page_id, replace({text}, '<urn:page:' || coalesce(page_id::VARCHAR, '') || '>', '<urn:page:' || (-1 - page_id) || '>') AS t FROM p WHERE ends_with(digest, '02')),
f AS (SELECT page_id, sha256(t) AS digest, strlen(t)::BIGINT AS length, count(*) AS copies FROM e GROUP BY ALL)
SELECT page_id, l.archive, position, "offset"::BIGINT AS "offset", length, copies, digest, root, CASE right(digest, 2) WHEN '00' THEN 'altered' WHEN '01' THEN 'missing' WHEN '03' THEN 'more' ELSE 'intact' END AS state FROM l JOIN t2 ON t2.archive = l.archive
UNION ALL
SELECT page_id, ('0x' || substr(md5(page_id::VARCHAR || '|' || digest), 1, 8))::BIGINT % n.n, NULL, NULL, length, copies, digest, NULL, 'added' FROM f CROSS JOIN n
"""


SQL = _sql()
