"""Merkle fixity audit of web archives: two replicas, compared from the roots down.

Pages become WARC records. An archive holds the records of ``span`` consecutive page
ids, ordered by (page_id, url, digest), with their offsets; rows without an id are spread over archives of
their own by a hash of url and html. Leaves are SHA-256 sums of whole records. A record's slot is the place of its id
in the archive's span (a hash for rows without an id), and a node covers a range of slots: it hashes
the digests and lengths of its (at most ``fanout``) child ranges in order, the lowest nodes those of their records. As ranges
belong to ids and not to positions, a record that is lost or added changes the nodes above it and no others.

The audit compares root digests and descends only below nodes that differ. Under the lowest nodes that differ,
records that both replicas hold cancel out; what is left is aligned by (page_id, url).

Nulls: a null url or html is empty. Repeated rows are records of their own; the records of one id share a
node. An empty table has no archive and no finding. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.common import stored, table

SPAN = 512
FANOUT = 8


def record(page_id: Column, url: Column, html: Column) -> Column:
    """The whole WARC record of a page as text; its UTF-8 bytes are what is stored."""
    body = F.coalesce(html, F.lit(""))
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "),
        F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
        body,
        F.lit("\r\n\r\n"),
    )


def leaves(pages: DataFrame, span: int = SPAN) -> DataFrame:
    """One row per record: archive, slot, place, offset range and digest. Shuffles no page text."""
    spread = F.xxhash64(F.coalesce("url", F.lit("")), F.coalesce("html", F.lit("")))
    orphan = F.concat(F.lit("x"), F.pmod(spread, F.lit(4096)).cast("string"))
    hashed = F.pmod(F.shiftrightunsigned(spread, 12), F.lit(span))
    records = pages.select(
        "page_id",
        F.coalesce(F.expr(f"cast(floor(page_id / {span}) as bigint)").cast("string"), orphan).alias("archive"),
        F.coalesce(F.pmod("page_id", F.lit(span)), hashed).cast("bigint").alias("slot"),
        F.coalesce("url", F.lit("")).alias("url"),
        record(F.col("page_id"), F.col("url"), F.col("html")).alias("record"),
    ).select(
        "page_id", "archive", "slot", "url", F.octet_length("record").cast("bigint").alias("length"), F.sha2("record", 256).alias("digest")
    )
    order = Window.partitionBy("archive").orderBy("page_id", "slot", "url", "digest")
    return records.select(
        "archive",
        "slot",
        (F.row_number().over(order) - 1).cast("bigint").alias("node"),
        (F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("length")).alias("offset"),
        "length",
        "digest",
        "page_id",
        "url",
    )


def parents(nodes: DataFrame, fanout: int, place: str = "node") -> DataFrame:
    """The level above: each node hashes what lies in its range of ``place``, in order of place and offset."""
    child = F.array_sort(F.collect_list(F.struct(place, "offset", "length", "digest")))
    grouped = nodes.groupBy("archive", F.expr(f"{place} div {fanout}").alias("node")).agg(child.alias("c"))
    part = F.transform("c", lambda x: F.concat_ws(":", x["length"].cast("string"), x["digest"]))
    return grouped.select(
        "archive",
        "node",
        F.col("c")[0]["offset"].alias("offset"),
        F.aggregate("c", F.lit(0).cast("bigint"), lambda total, x: total + x["length"]).alias("length"),
        F.sha2(F.concat_ws("\n", part), 256).alias("digest"),
    )


def tree(pages: DataFrame, span: int = SPAN, fanout: int = FANOUT) -> list[DataFrame]:
    """Levels from the records to one root per archive, each stored once."""
    levels = [stored(leaves(pages, span), "leaves")]
    slots, place = span, "slot"
    while slots > 1:
        levels.append(stored(parents(levels[-1], fanout, place), "nodes"))
        slots, place = -(-slots // fanout), "node"
    return levels


def audit(left: list[DataFrame], right: list[DataFrame], fanout: int = FANOUT) -> DataFrame:
    """Records that differ between two replicas' trees of equal span and fanout.

    A record that one replica lacks has nulls on that side. Only children of mismatching nodes are
    read below each level.
    """
    suspects = None
    for level in range(len(left) - 1, 0, -1):
        sides = []
        for name, levels in (("", left), ("replica_", right)):
            rows = below(levels[level], suspects, "node", fanout)
            sides.append(rows.select("archive", "node", F.col("length").alias(name + "length"), F.col("digest").alias(name + "digest")))
        both = sides[0].join(sides[1], ["archive", "node"], "full_outer")
        found = both.where(
            ~F.col("digest").eqNullSafe(F.col("replica_digest")) | ~F.col("length").eqNullSafe(F.col("replica_length"))
        )
        suspects = stored(found.select("archive", F.col("node").alias("parent")), "suspects")
    records = [below(levels[0], suspects, "slot", fanout) for levels in (left, right)]
    return aligned(*records)


def below(nodes: DataFrame, suspects: DataFrame | None, place: str, fanout: int) -> DataFrame:
    """The children of mismatching nodes; all of the roots' level."""
    if suspects is None:
        return nodes
    return nodes.withColumn("parent", F.expr(f"{place} div {fanout}")).join(suspects, ["archive", "parent"], "left_semi")


def aligned(left: DataFrame, right: DataFrame) -> DataFrame:
    """Records of one side that the other lacks or holds otherwise, paired by page_id and url."""
    name = ["archive", "page_id", "url"]
    both = left.withColumn("side", F.lit(0)).unionByName(right.withColumn("side", F.lit(1)))
    numbered = both.withColumn("copy", F.row_number().over(Window.partitionBy(*name, "digest", "side").orderBy("node")))
    held = Window.partitionBy(*name, "digest", "copy")
    rest = numbered.withColumn("sides", F.count("*").over(held)).where("sides = 1")
    ranked = rest.withColumn("k", F.row_number().over(Window.partitionBy(*name, "side").orderBy("digest", "copy")))
    fields = ["node", "offset", "length", "digest"]
    pairs = ranked.groupBy(*name, "k").agg(
        *(F.max(F.when(F.col("side") == side, F.struct(*fields))).alias(label) for side, label in ((0, "own"), (1, "other")))
    )
    return pairs.select(
        "archive",
        F.coalesce("own.node", "other.node").alias("record_no"),
        "page_id",
        "own.offset",
        "own.length",
        "own.digest",
        F.col("other.offset").alias("replica_offset"),
        F.col("other.length").alias("replica_length"),
        F.col("other.digest").alias("replica_digest"),
        F.when(F.col("own").isNull(), "extra")
        .when(F.col("other").isNull(), "missing")
        .when(F.col("own.length") > F.col("other.length"), "truncated")
        .otherwise("changed")
        .alias("kind"),
    )


def damaged(pages: DataFrame) -> DataFrame:
    """A second replica with known damage: cut bodies and single replaced characters."""
    cut = F.expr("substring(html, 1, int(char_length(html) / 2))")
    changed = F.concat(F.lit("#"), F.expr("substring(html, 2)"))
    return pages.withColumn(
        "html", F.when(F.col("page_id") % 101 == 7, cut).when(F.col("page_id") % 89 == 3, changed).otherwise(F.col("html"))
    )


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return audit(tree(pages), tree(damaged(pages)))


_RECORD = (
    "'WARC/1.0\\r\\nWARC-Type: response\\r\\nWARC-Record-ID: <urn:page:' || page_id || '>\\r\\nWARC-Target-URI: ' || url"
    " || '\\r\\nContent-Length: ' || strlen(html) || '\\r\\n\\r\\n' || html || '\\r\\n\\r\\n'"
).replace("\\r\\n", "' || chr(13) || chr(10) || '")

ORACLE_SQL = f"""
WITH bodies AS (
    SELECT page_id, url, html, false AS second FROM pages
    UNION ALL
    SELECT page_id, url, CASE WHEN page_id % 101 = 7 THEN substr(html, 1, length(html) // 2)
        WHEN page_id % 89 = 3 THEN '#' || substr(html, 2) ELSE html END, true FROM pages),
records AS (SELECT page_id, url, second, {_RECORD} AS r FROM bodies),
placed AS (
    SELECT page_id, second, CAST(page_id // {SPAN} AS VARCHAR) AS archive, sha256(r) AS digest,
        CAST(strlen(r) AS BIGINT) AS length,
        row_number() OVER w - 1 AS node,
        CAST(sum(strlen(r)) OVER (PARTITION BY second, page_id // {SPAN} ORDER BY page_id, url
            ROWS UNBOUNDED PRECEDING) AS BIGINT) - CAST(strlen(r) AS BIGINT) AS "offset"
    FROM records WINDOW w AS (PARTITION BY second, page_id // {SPAN} ORDER BY page_id, url))
SELECT a.archive, a.node AS record_no, a.page_id, a."offset", a.length, a.digest,
    b."offset" AS replica_offset, b.length AS replica_length, b.digest AS replica_digest,
    CASE WHEN a.length > b.length THEN 'truncated' ELSE 'changed' END AS kind
FROM placed a JOIN placed b ON a.archive = b.archive AND a.node = b.node
WHERE NOT a.second AND b.second AND a.digest <> b.digest
"""
