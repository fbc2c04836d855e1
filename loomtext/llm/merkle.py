"""Document fingerprints: a Merkle tree over paragraphs and sections.

A paragraph is a line; its node is the SHA-256 of its text. A section is a run of ``SECTION`` paragraphs; its node is the SHA-256
of theirs. The root covers the section nodes and is the fingerprint: texts are equal exactly if their roots are. Where roots
differ, only sections that differ are looked into, which gives the paragraphs that were edited. Below a paragraph
lie chunks of words, the lowest nodes, each with a 64-bit mark: a chunk ends where a word ends in certain letters, so a word that is put in, taken out or changed
changes its own chunk and no other. How many of these nodes two trees share is how much of the texts is alike.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomtext.llm.common import saved
from loomtext.llm.sharding import count_below, lookup, order_key, splitters

#: Paragraphs of a section, most words of a chunk, and characters after which a word without an end is cut.
SECTION, RUN, LONG = 8, 8, 24
#: Characters that end a chunk where they end a word: about a third of the words of a European text do.
ENDS = "en0-3.!?\u3002\uff01\uff1f"
#: Bytes of neighbouring documents that one task looks at together; at most so many ranges.
RANGE_BYTES, RANGES = 8 << 20, 8192


def paragraphs(text: Column) -> Column:
    """Nodes of the paragraphs, as hex."""
    return F.transform(F.split(text, "\n"), lambda p: F.sha2(p, 256))


def sections(nodes: Column, section: int = SECTION) -> Column:
    """Nodes of the sections over paragraph nodes."""
    starts = F.sequence(F.lit(1), F.size(nodes), F.lit(section))
    return F.transform(starts, lambda i: F.sha2(F.concat_ws("/", F.slice(nodes, i, section)), 256))


def root(nodes: Column) -> Column:
    """The fingerprint over section nodes. The tag keeps a section from being taken for a root."""
    return F.sha2(F.concat(F.lit("root:"), F.concat_ws("/", nodes)), 256)


def marks(text: Column, run: int = RUN) -> Column:
    """64-bit marks of the chunks of every line, in order; a chunk ends with its line at the latest. Line ends are chunks."""
    word = rf"[^\x20\x0A]{{1,{LONG}}}+"
    chunk = rf"(?:{word}(?<![{ENDS}])\x20++){{0,{run - 1}}}{word}\x20*+|\x20++|\x0A"
    return F.transform(F.regexp_extract_all(text, F.lit(chunk), F.lit(0)), lambda r: F.xxhash64(r))


def likeness(one: Column, other: Column) -> Column:
    """0 to 1 from two lists of marks: the share of different marks they have in common, or, if greater, the share of
    the longer list that lies in an equal beginning. 1 for equal lists, empty ones too."""
    common = F.size(F.array_intersect(one, other))
    all_marks = F.size(F.array_union(one, other))
    longer, shorter = F.greatest(F.size(one), F.size(other)), F.least(F.size(one), F.size(other))
    odd = F.array_position(F.zip_with(F.slice(one, 1, shorter), F.slice(other, 1, shorter), lambda a, b: a == b), False)
    head = F.when(odd == 0, shorter).otherwise(odd - 1)
    return F.when(all_marks == 0, F.lit(1.0)).otherwise(F.greatest(common / all_marks, head / longer).cast("double"))


def fingerprints(docs: DataFrame, section: int = SECTION) -> DataFrame:
    """(doc_id, fingerprint, sections, paragraphs) of every row of ``docs``.

    A null text counts as empty, which is one empty paragraph. Repeated rows have repeated results; other columns are left out.
    """
    nodes = docs.select("doc_id", paragraphs(F.coalesce("text", F.lit(""))).alias("paragraphs"))
    return nodes.withColumn("sections", sections(F.col("paragraphs"), section)).select(
        "doc_id", root(F.col("sections")).alias("fingerprint"), "sections", "paragraphs"
    )


def edits(before: DataFrame, after: DataFrame, section: int = SECTION) -> DataFrame:
    """(doc_id, section, paragraph) from 0 for every place where two versions of a document (by doc_id) differ.

    Both are tables of ``fingerprints``. Documents with equal roots are left at the root, equal sections at the section; a
    paragraph that only one version has differs. doc_id must be unique in each; null ids and documents of one side only are not compared.
    """
    old = before.select("doc_id", *[F.col(c).alias(f"old_{c}") for c in ("fingerprint", "sections", "paragraphs")])
    pairs = old.join(after, "doc_id").where("old_fingerprint != fingerprint")
    changed = pairs.select(
        "*",
        F.posexplode(F.arrays_zip(F.col("old_sections").alias("was"), F.col("sections").alias("now"))).alias("section", "nodes"),
    ).where(~F.col("nodes.was").eqNullSafe(F.col("nodes.now")))
    inside = changed.select(
        "doc_id",
        "section",
        F.posexplode(
            F.arrays_zip(
                F.slice("old_paragraphs", F.col("section") * section + 1, section).alias("was"),
                F.slice("paragraphs", F.col("section") * section + 1, section).alias("now"),
            )
        ).alias("at", "nodes"),
    ).where(~F.col("nodes.was").eqNullSafe(F.col("nodes.now")))
    return inside.select("doc_id", "section", (F.col("section") * section + F.col("at")).alias("paragraph"))


def with_next(docs: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(doc_id, text, next_text): every document beside the next one by doc_id; after the last comes the first.

    The rows are cut into ranges of equal bytes by exact splitters, each range is sorted alone, and the first row of a range is also sent to
    the range before it. One exchange; a repeated doc_id is ordered by the text's hash. Null texts come as the empty text.
    """
    source = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    keyed = source.withColumn("__key", order_key(F.col("doc_id"), F.xxhash64("text")))
    narrow = saved(keyed.select("__key", (F.octet_length("text") + 64).cast("bigint").alias("__size")), "order")
    total = narrow.agg(F.sum("__size")).first()[0] or 0
    ranges = max(1, min(RANGES, math.ceil(total / range_bytes)))
    cuts = sorted(set(splitters(narrow, [total * i / ranges for i in range(1, ranges)], 0.2 * total / ranges)))
    place = count_below("__key", cuts)
    # The first key of every range that has rows, at most RANGES of them, and the range before it; the first of all goes behind the last.
    firsts = [(r["at"], int(r["key"])) for r in narrow.groupBy(place.alias("at")).agg(F.min("__key").alias("key")).orderBy("at").collect()]
    keys, back = [0] * (len(cuts) + 1), [0] * (len(cuts) + 1)
    for i, (at, key) in enumerate(firsts):
        keys[at], back[at] = key, firsts[i - 1][0]
    placed = keyed.withColumn("__range", place)
    here = F.struct(F.col("__range").alias("at"), F.lit(False).alias("extra"))
    ahead = F.struct(lookup("__range", back, "int").alias("at"), F.lit(True).alias("extra"))
    first = F.col("__key") == lookup("__range", keys, "decimal(38,0)")
    sent = placed.withColumn("__to", F.explode(F.when(first, F.array(here, ahead)).otherwise(F.array(here)))).select(
        "doc_id", "text", "__key", F.col("__to.at").alias("__at"), F.col("__to.extra").alias("__extra")
    )
    following = F.lead("text").over(Window.partitionBy("__at").orderBy("__extra", "__key"))
    return sent.withColumn("next_text", following).where("NOT __extra").select("doc_id", "text", "next_text")


def edited_likeness(docs: DataFrame) -> DataFrame:
    """Per document its fingerprint and that of an edited text, with the likeness to it and to the next document.

    The edit replaces the last quarter of the code points (rounded down) by as many from the start of the next document by doc_id, or all it has. One row
    per row of ``docs``; null texts count as empty, and a lone document is its own next one.
    """
    pairs = with_next(docs).withColumn("n_chars", F.char_length("text").cast("bigint"))
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    kept = F.substring("text", F.lit(1), F.col("n_chars").cast("int") - quarter)
    rows = pairs.withColumn("edited", F.concat(kept, F.substring("next_text", F.lit(1), quarter)))
    own, edited = marks(F.col("text")), marks(F.col("edited"))
    hashed = rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        paragraphs(F.col("text")).alias("old"),
        paragraphs(F.col("edited")).alias("new"),
        own.alias("own_marks"),
        edited.alias("edited_marks"),
        marks(F.col("next_text")).alias("next_marks"),
    )
    return hashed.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        root(sections(F.col("old"))).alias("fingerprint"),
        root(sections(F.col("new"))).alias("edited_fingerprint"),
        likeness(F.col("own_marks"), F.col("edited_marks")).alias("near_edited"),
        likeness(F.col("own_marks"), F.col("next_marks")).alias("near_next"),
    )
