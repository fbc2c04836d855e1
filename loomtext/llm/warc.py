"""WARC archives and their fixity audit by Merkle trees.

Every record is hashed; runs of ``FAN`` nodes, in the order of their offsets, are hashed into a node of the next level, up to one root per file
and one of the archive. Two replicas are compared from the roots down: only the branches that differ are looked into, until the
damaged records are found, with their place.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomtext.llm.common import saved
from loomtext.llm.sharding import histogram_sort

#: Children of a node; records of a file at least; files at most.
FAN, FILE_RECORDS, FILES = 32, 2048, 8192
#: Fixed by the format: the first line of a record, and what ends it.
VERSION, END = "WARC/1.0\r\n", "\r\n\r\n"


def record(page_id: Column, url: Column, html: Column) -> Column:
    """A resource record without its end mark. Line breaks in an address are percent-encoded."""
    address = F.replace(F.replace(F.coalesce(url, F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    payload = F.coalesce(html, F.lit(""))
    return F.concat(
        F.lit(VERSION + "WARC-Type: resource\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "),
        address,
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(payload).cast("string"),
        F.lit(END),
        payload,
    )


def archive(pages: DataFrame, file_records: int = FILE_RECORDS) -> DataFrame:
    """(file, record_no, page_id, record): pages in the order of their ids, cut into files of equal numbers of records.

    A file has ``file_records`` records, or as many as make ``FILES`` files. Pages of one id are ordered by the hash of their url and
    html; null ids come first, null urls and pages count as empty.
    """
    source = pages.select("page_id", record(F.col("page_id"), F.col("url"), F.col("html")).alias("record"))
    rows = pages.count()
    each = max(file_records, math.ceil(rows / FILES))
    files = max(1, math.ceil(rows / each))
    # Sizes of 1 and shares of ``each`` rows: all files but the last are full.
    placed = histogram_sort(
        source, F.col("page_id"), F.xxhash64("record"), F.lit(1), files, tolerance=0.0, shares=[each * i for i in range(1, files)]
    )
    return placed.select(F.col("shard").alias("file"), F.col("slot").alias("record_no"), "page_id", "record")


def write_warc(records: DataFrame, path: str, order: str = "record_no", exchange: bool = True) -> None:
    """One gzip WARC file per ``file``, in a folder of that name, its records in the order of the column ``order``.

    ``exchange=False`` if the rows of a file already lie in one task, as ``archive`` and ``read_warc`` leave them.
    """
    placed = records.repartition("file") if exchange else records
    ordered = placed.sortWithinPartitions("file", order).select(F.col("record").cast("string").alias("record"), "file")
    ordered.write.partitionBy("file").option("lineSep", END).option("compression", "gzip").text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(file, at, page_id, record): records as bytes, without end mark; ``at`` orders those of a file.

    A compressed file is read by one task, in order. A payload that holds the end mark followed by the version line cannot be told from a new record.
    """
    lines = spark.read.schema("value string, file int").option("lineSep", END + VERSION).text(path)
    head = F.substring_index("value", END, 1)
    data = F.col("value").cast("binary")
    # The first record of a file still has its version line, the last one its end mark: more bytes than it says it has.
    said = F.octet_length(head) + len(END) + F.expr("try_cast(regexp_extract(head, 'Content-Length: ([0-9]+)', 1) AS bigint)")
    whole = F.when(F.octet_length("value") == said + len(END), F.substring(data, F.lit(1), said.cast("int"))).otherwise(data)
    first = F.startswith("value", F.lit(VERSION))
    page = F.expr("try_cast(regexp_extract(head, 'urn:page:(-?[0-9]+)>', 1) AS bigint)")
    return lines.withColumn("head", head).select(
        "file",
        F.monotonically_increasing_id().alias("at"),
        page.alias("page_id"),
        F.when(first, whole).otherwise(F.concat(F.lit(VERSION).cast("binary"), whole)).alias("record"),
    )


def leaves(records: DataFrame) -> DataFrame:
    """(file, no, at, page_id, start, end, hash): the leaves of a replica, from what ``read_warc`` returns."""
    narrow = saved(
        records.select(
            "file",
            "at",
            "page_id",
            F.octet_length("record").cast("bigint").alias("length"),
            F.sha2("record", 256).alias("hash"),
        ),
        "leaves",
    )
    # A file has a bounded number of records; what is left of them is a few numbers each.
    order = Window.partitionBy("file").orderBy("at")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    return saved(
        narrow.select(
            "file",
            (F.row_number().over(order) - 1).cast("bigint").alias("no"),
            "page_id",
            "at",
            F.coalesce(F.sum(F.col("length") + len(END)).over(before), F.lit(0)).alias("start"),
            "length",
            "hash",
        ).select("file", "no", "at", "page_id", "start", (F.col("start") + F.col("length")).alias("end"), "hash"),
        "tree",
    )


def _hash_of(nodes: DataFrame, by: list[str], order: str) -> DataFrame:
    inside = F.transform(F.sort_array(F.collect_list(F.struct(order, "hash"))), lambda n: n["hash"])
    return nodes.groupBy(*by).agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.sha2(F.concat_ws("/", inside), 256).alias("hash")
    )


def levels(nodes: DataFrame, fan: int = FAN) -> list[DataFrame]:
    """Levels of the tree over ``leaves``, from the leaves to one node per file: (file, no, start, end, hash)."""
    found = [nodes]
    most = nodes.agg(F.max("no")).first()[0] or 0
    while most > 0:
        up = found[-1].withColumn("parent", F.expr(f"no div {fan}"))
        found.append(saved(_hash_of(up, ["file", "parent"], "no").withColumnRenamed("parent", "no"), "tree"))
        most //= fan
    return found


def archive_root(tree: list[DataFrame]) -> str:
    """Root of the archive over the roots of its files, of which there are at most ``FILES``."""
    return _hash_of(tree[-1].withColumn("all", F.lit(1)), ["all"], "file").agg(F.max("hash")).first()[0] or ""


def audit(expected: DataFrame, found: DataFrame, fan: int = FAN) -> DataFrame:
    """Damaged records of the replica ``found`` against ``expected`` (both from ``leaves``).

    Returns file, record_no, page_id, offset, length, found_length, kind, expected_sha256, found_sha256. ``kind`` is changed, resized, missing or extra; of a missing
    record the found values are null, of an extra one the expected ones. Equal replicas, empty ones too, give no rows. Records are compared by their
    number in the file: one that is lost from the middle shows as damage of all after it.
    """
    trees = [levels(expected, fan), levels(found, fan)]
    depth = max(map(len, trees))
    for tree in trees:  # files of few records are single nodes long before the top
        while len(tree) < depth:
            top = tree[-1].withColumn("parent", F.lit(0).cast("bigint"))
            tree.append(saved(_hash_of(top, ["file", "parent"], "no").withColumnRenamed("parent", "no"), "tree"))
    suspects: DataFrame | None = None
    if archive_root(trees[0]) == archive_root(trees[1]):
        suspects = expected.select("file", "no").limit(0)
    for level in reversed(range(depth)):
        sides = []
        for tree in trees:
            nodes = tree[level]
            if suspects is not None:
                below = suspects.select("file", F.col("no").alias("parent"))
                nodes = nodes.withColumn("parent", F.expr(f"no div {fan}")).join(below, ["file", "parent"], "left_semi").drop("parent")
            sides.append(nodes)
        one = sides[0].select("file", "no", *[F.col(c).alias(f"a_{c}") for c in sides[0].columns if c not in ("file", "no")])
        two = sides[1].select("file", "no", *[F.col(c).alias(f"b_{c}") for c in sides[1].columns if c not in ("file", "no")])
        differing = one.join(two, ["file", "no"], "full").where(~F.col("a_hash").eqNullSafe(F.col("b_hash")))
        suspects = saved(differing, "differing")
    length, other = F.col("a_end") - F.col("a_start"), F.col("b_end") - F.col("b_start")
    kind = (
        F.when(F.col("b_hash").isNull(), "missing")
        .when(F.col("a_hash").isNull(), "extra")
        .when(length != other, "resized")
        .otherwise("changed")
    )
    return suspects.select(
        "file",
        F.col("no").alias("record_no"),
        F.coalesce("a_page_id", "b_page_id").alias("page_id"),
        F.col("a_start").alias("offset"),
        length.alias("length"),
        other.alias("found_length"),
        kind.alias("kind"),
        F.col("a_hash").alias("expected_sha256"),
        F.col("b_hash").alias("found_sha256"),
    )


def aged(records: DataFrame, tree: DataFrame) -> DataFrame:
    """A replica with the damage of years, by fixed rules, to try the audit on: from what ``read_warc`` returns and its ``leaves``.

    By the hash of its page, one record in 43 has another last byte and one in 85 has lost it; every third file lacks its last record.
    """
    chance = F.substring(F.md5(F.coalesce(F.col("page_id").cast("string"), F.lit(""))), 1, 2)
    last = tree.groupBy("file").agg(F.max("no").alias("__last"), F.max("at").alias("__end"))
    # One row for each of at most FILES files.
    ends = F.broadcast(last.where("file % 3 = 1 AND __last > 0").select(F.col("file").alias("__file"), "__end"))
    kept = records.join(ends, (F.col("file") == F.col("__file")) & (F.col("at") == F.col("__end")), "left_anti")
    short = F.substring("record", F.lit(1), F.octet_length("record") - 1)
    damaged = (
        F.when(chance < "06", F.concat(short, F.lit("#").cast("binary"))).when(chance >= "fd", short).otherwise(F.col("record"))
    )
    return kept.select("file", "at", damaged.alias("record"))
