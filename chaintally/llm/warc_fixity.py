"""WARC fixity audit with Merkle trees.

Method.  A replica is files of records in an order of their own.  Every record has an offset range in its
file; a leaf is the SHA-256 of (file, offset, length, digest).  An inner node covers the range
from its first child's start to its last one's end, and is the SHA-256 of that range and of its children's
slots and hashes.  A file's tree ends in one node; above the files, nodes are slots of the hash of the file's name, up to
one root.  Two replicas' roots are compared first; only below nodes that differ are the children compared.  Each
replica is numbered from its own file order, so a record cut out shifts all that follow it in its file, and all
these leaves differ; below the differing branches the records of both replicas are therefore aligned by
their ids, and those that only moved are not reported.

Scale.  A node has at most ``FANOUT`` children, so no group is larger (in the lowest slots of
file names, a few files), and each level is a FANOUT-th of the one below.  Record bytes are hashed where they are
read and never shuffled; records are numbered file by file.  The descent joins the differing nodes of a level with
the next level, so its cost follows the damage: at most the damaged files.

Status: ``changed``, ``missing`` (not in the second replica) or ``extra`` (not in the first).

Defined cases: a null url or payload is an empty one; a null page_id sorts
first; rows that repeat a page are records of their own; an id that a
replica holds twice counts with its least digest, and its copies make it
differ; a file that one replica lacks has all its records missing; equal replicas and empty tables give an empty
result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chaintally.llm.common import dense_index, stage, table

FANOUT = 16
# Records of one WARC file.
FILE_RECORDS = 1024


def record_text(url: Column, payload: Column) -> Column:
    """A response record: header lines, an empty line, the payload, two line ends."""
    url, payload = F.coalesce(url, F.lit("")), F.coalesce(payload, F.lit(""))
    return F.concat(F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "), url, F.lit("\r\nContent-Length: "),
                    F.octet_length(payload).cast("string"), F.lit("\r\n\r\n"), payload, F.lit("\r\n\r\n"))


def fixity(text: Column) -> Column:
    return F.struct(F.octet_length(text).cast("long").alias("length"), F.sha2(text, 256).alias("digest"))


def with_offsets(records: DataFrame) -> DataFrame:
    """node (number of the record in its file) and offset (bytes before it) from (file, place, length): ``place`` gives the order."""
    order = Window.partitionBy("file").orderBy("place")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    return (records.withColumn("node", F.row_number().over(order).cast("long") - 1)
                   .withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0))))


def _parents(level: DataFrame, keys: list, node, slot, fanout_range: bool) -> DataFrame:
    """The next level: the hash of each node's range, slots and children's hashes."""
    children = F.sort_array(F.collect_list(F.struct(slot.alias("slot"), F.col("hash"))))
    ranges = [F.min("start").alias("start"), F.max("end").alias("end")] if fanout_range else []
    grouped = level.groupBy(*keys, node.alias("node")).agg(children.alias("children"), *ranges)
    texts = F.transform("children", lambda c: F.concat_ws(":", c["slot"].cast("string"), c["hash"]))
    covered = [F.concat_ws("-", F.col("start").cast("string"), F.col("end").cast("string"))] if fanout_range else []
    kept = [*keys, "node", *(["start", "end"] if fanout_range else [])]
    return grouped.select(*kept, F.sha2(F.concat_ws("|", *covered, F.array_join(texts, "|")), 256).alias("hash"))


def tree(records: DataFrame, depth: int, widths: list[int], fanout: int, name: str) -> tuple[DataFrame, list[DataFrame], list[DataFrame]]:
    """Leaves, the levels of the files' trees (lowest first), and the levels above the files (lowest first).

    ``depth``: levels above the leaves within a file; ``widths``: slots of file names at each level above, down to 1.
    """
    numbered = with_offsets(records)
    leaf = F.sha2(F.concat_ws(":", F.col("file").cast("string"), F.col("offset").cast("string"), F.col("length").cast("string"), "digest"), 256)
    leaves = stage(numbered.select("record_id", "file", "node", "offset", "length", "digest", leaf.alias("hash")), f"{name}-leaves")
    levels = [leaves.select("file", "node", F.col("offset").alias("start"), (F.col("offset") + F.col("length")).alias("end"), "hash")]
    for k in range(depth):
        levels.append(stage(_parents(levels[-1], ["file"], F.floor(F.col("node") / fanout), F.col("node") % fanout, True), f"{name}-{k + 1}"))
    above, below = [], levels[-1].select(F.col("file").alias("slot"), _slot(widths[0]).alias("node"), "hash")
    for k, width in enumerate(widths):
        if k:
            below = above[-1].select((F.col("node") % fanout).alias("slot"), F.floor(F.col("node") / fanout).alias("node"), "hash")
        above.append(stage(_parents(below, [], F.col("node"), F.col("slot"), False), f"{name}-above-{k}"))
    return leaves, levels, above


def _slot(width: int) -> Column:
    return F.pmod(F.xxhash64(F.col("file").cast("string")), F.lit(width))


def _differing(one: DataFrame, two: DataFrame, keys: list[str], name: str) -> DataFrame:
    pairs = one.select(*keys, F.col("hash").alias("a")).join(two.select(*keys, F.col("hash").alias("b")), keys, "full_outer")
    return stage(pairs.where(~F.col("a").eqNullSafe(F.col("b"))).select(*keys), name)


def _by_id(leaves: DataFrame, tag: str) -> DataFrame:
    """One row per record id: how often it stands, and its least digest and length."""
    return leaves.groupBy("record_id").agg(F.struct(F.count("*").alias("n"), F.min(F.struct("digest", "length")).alias("least")).alias(tag))


def audit(first: DataFrame, second: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """record_id and status of every record that differs between replicas (record_id, file, place, length, digest)."""
    sizes = [df.groupBy("file").agg(F.count("*").alias("n")).agg(F.max("n"), F.count("*")).first() for df in (first, second)]
    longest, files = (max(int(s[k] or 0) for s in sizes) for k in (0, 1))
    depth, width = 0, 1
    while fanout ** depth < longest:
        depth += 1
    while width < files:
        width *= fanout
    widths = [width]
    while widths[-1] > 1:
        widths.append(widths[-1] // fanout)
    (leaves_a, a, above_a), (leaves_b, b, above_b) = (tree(df, depth, widths, fanout, f"fixity-{tag}") for df, tag in ((first, "a"), (second, "b")))
    differing = None
    for one, two in zip(reversed(above_a), reversed(above_b)):
        if differing is not None:
            parent = differing.withColumnRenamed("node", "parent")
            one, two = (t.join(parent, F.floor(F.col("node") / fanout) == F.col("parent"), "left_semi") for t in (one, two))
        differing = _differing(one, two, ["node"], "fixity-slots")
    slots, below = differing.withColumnRenamed("node", "parent"), None
    for one, two in zip(reversed(a), reversed(b)):
        if below is None:
            one, two = (t.join(slots, _slot(widths[0]) == F.col("parent"), "left_semi") for t in (one, two))
        else:
            one, two = (_under(t, below, fanout) for t in (one, two))
        below = _differing(one, two, ["file", "node"], "fixity-differing")
    # the records of the differing leaves; a record that only moved is in both lists
    found = [_by_id(leaves.join(below, ["file", "node"], "left_semi"), tag) for leaves, tag in ((leaves_a, "a"), (leaves_b, "b"))]
    odd = found[0].join(found[1], "record_id", "full_outer").where(~F.col("a").eqNullSafe(F.col("b"))).select("record_id")
    odd = stage(odd, "fixity-odd")
    # what the whole replicas hold of these ids decides
    held = [_by_id(leaves.join(odd, "record_id", "left_semi"), tag) for leaves, tag in ((leaves_a, "a"), (leaves_b, "b"))]
    status = F.when(F.col("a").isNull(), "extra").when(F.col("b").isNull(), "missing").otherwise("changed")
    return held[0].join(held[1], "record_id", "full_outer").where(~F.col("a").eqNullSafe(F.col("b"))).select("record_id", status.alias("status"))


def _under(level: DataFrame, parents: DataFrame, fanout: int) -> DataFrame:
    """The nodes of a level below differing ones."""
    up = parents.select(F.col("file").alias("of"), F.col("node").alias("parent"))
    return level.join(up, F.col("file").eqNullSafe(F.col("of")) & (F.floor(F.col("node") / fanout) == F.col("parent")), "left_semi")


def op7_warc_fixity(spark, sf_dir: str) -> DataFrame:
    """Audit of the pages' WARC records against a replica damaged by a stated rule.

    By page_id modulo 97: 0, a byte is appended to the payload; 1, the second half of
    the payload is lost; 2, the record is missing; 3, it is missing in the first replica.
    """
    pages = table(spark, sf_dir, "pages")
    rule = F.pmod("page_id", F.lit(97))
    payload = F.coalesce("html", F.lit(""))
    damaged = (F.when(rule == 0, F.concat(payload, F.lit("#")))
                .when(rule == 1, F.substring(payload, F.lit(1), F.floor(F.length(payload) / 2).cast("int"))).otherwise(payload))
    slim = pages.select("page_id", "url", fixity(record_text(F.col("url"), payload)).alias("a"),
                        fixity(record_text(F.col("url"), damaged)).alias("b")).withColumn("digest", F.col("a.digest"))
    rows = stage(dense_index(slim, ["page_id", "url", "digest"], "fixity-order"), "fixity-records")
    rows = rows.withColumn("file", F.floor(F.col("index") / FILE_RECORDS)).withColumn("place", F.col("index"))
    # each replica holds the same files, numbered and measured by the records it has
    first = rows.where(F.coalesce(rule != 3, F.lit(True))).select(F.col("index").alias("record_id"), "file", "place", "a.length", "a.digest")
    second = rows.where(F.coalesce(rule != 2, F.lit(True))).select(F.col("index").alias("record_id"), "file", "place", "b.length", "b.digest")
    placed = with_offsets(rows.select("index", "page_id", "url", "file", "place", "a.length"))
    found = audit(first, second).withColumnRenamed("record_id", "index")
    return found.join(placed, "index").select("index", "page_id", "url", "file", "offset", "length", "status")


OP7_SQL = r"""
WITH p AS (
  SELECT page_id, url, coalesce(html, '') AS payload, chr(13) || chr(10) AS nl FROM pages),
d AS (
  SELECT *, CASE page_id % 97 WHEN 0 THEN payload || '#' WHEN 1 THEN substr(payload, 1, length(payload) // 2) ELSE payload END AS damaged
  FROM p),
r AS (
  SELECT page_id, url, payload, damaged,
         'WARC/1.1' || nl || 'WARC-Type: response' || nl || 'WARC-Target-URI: ' || coalesce(url, '') || nl
           || 'Content-Length: ' || strlen(payload) || nl || nl || payload || nl || nl AS record
  FROM d),
n AS (
  SELECT *, strlen(record) AS length,
         row_number() OVER (ORDER BY page_id NULLS FIRST, url NULLS FIRST, sha256(record)) - 1 AS index FROM r),
o AS (
  SELECT *, index // 1024 AS file,
         CAST(sum(length) OVER (PARTITION BY index // 1024 ORDER BY index) - length AS BIGINT) AS offset FROM n)
SELECT index, page_id, url, file, "offset", length,
       CASE WHEN page_id % 97 = 2 THEN 'missing' WHEN page_id % 97 = 3 THEN 'extra' ELSE 'changed' END AS status
FROM o WHERE page_id % 97 IN (2, 3) OR payload <> damaged
"""
