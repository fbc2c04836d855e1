"""Exact de-duplication by deterministic block naming.

A text is cut into blocks of fixed size. Equal blocks get one integer name, different blocks different ones:
the blocks are sorted by hash, and where two contents share a hash, by content. Then adjacent names are paired
and the pairs named, again and again, until one name is left. Two texts are equal exactly if they are
left with the same name after the same number of rounds. Hashes only speed the sort up: no result rests on one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomtext.llm.common import keep_rows, lower_ascii, row_hash, saved
from loomtext.operators.order import with_position

#: Bytes of a block.
BLOCK = 4096


def _hash64(value: Column) -> Column:
    return F.xxhash64(value)


def _numbered(distinct: DataFrame, order: list[str]) -> DataFrame:
    """``name`` from 1 in ``order``; the first column is a hash, whose leading bits split the sort evenly."""
    return with_position(distinct, order, F.shiftright(order[0], 52), "name").withColumn("name", F.col("name") + 1)


def _blocks(block: int) -> Column:
    """The blocks of the binary column ``bytes``; an empty text is one empty block."""
    return F.expr(
        f"transform(sequence(0, greatest(0, (octet_length(bytes) - 1) div {block})), i -> substring(bytes, int(i) * {block} + 1, {block}))"
    )


def named(docs: DataFrame, block: int = BLOCK, hash64=_hash64) -> DataFrame:
    """One row per different (doc_id, hash, text): doc_id, hash, copies, text_sha256, rounds, name.

    ``hash`` is that of the whole row. (rounds, name) is the text's identity: equal for equal normalised texts and for no others.
    """
    source = docs.select(
        "doc_id", row_hash(docs).alias("hash"), lower_ascii(F.coalesce("text", F.lit(""))).cast("binary").alias("bytes")
    )
    marked = source.select(
        "doc_id", "hash", F.sha2("bytes", 256).alias("text_sha256"), F.transform(_blocks(block), hash64).alias("marks")
    )
    texts = saved(marked.groupBy("doc_id", "hash", "text_sha256", "marks").agg(F.count("*").alias("copies")), "texts")
    key = ["doc_id", "hash", "text_sha256"]

    contents = source.select(F.explode(_blocks(block)).alias("content")).withColumn("mark", hash64(F.col("content")))
    extremes = contents.groupBy("mark").agg(F.min("content").alias("least"), F.max("content").alias("most"))
    marks = saved(extremes.select("mark", (F.col("least") != F.col("most")).alias("shared")), "marks")
    placed = texts.select(*key, F.posexplode("marks").alias("at", "mark"))
    shared = marks.where("shared")
    if shared.isEmpty():
        level = placed.join(_numbered(marks, ["mark"]).select("mark", "name"), "mark").select(*key, "at", "name")
    else:
        level = _by_content(source, shared.select("mark"), marks, block, hash64)
    done = []
    rounds = 0
    counts = texts.select(*key, F.size("marks").alias("blocks"), "copies")
    longest = texts.agg(F.max(F.size("marks"))).first()[0] or 1
    blocks = counts.select(*key, "blocks")
    while True:
        level = saved(level.select(*key, "at", "name"), "level")
        # 2 ** (rounds - 1) < blocks <= 2 ** rounds: one name is left after so many rounds.
        now = blocks.where((F.col("blocks") <= 2**rounds) & (F.col("blocks") > 2**rounds // 2))
        done.append(_same(level.where("at = 0"), now, key).select(*key, F.lit(rounds).alias("rounds"), "name"))
        if longest <= 2**rounds:
            break
        longer = _same(level, blocks.where(F.col("blocks") > 2**rounds), key)
        pairs = longer.groupBy(*key, F.expr("at div 2").cast("int").alias("at")).agg(
            F.max(F.when(F.col("at") % 2 == 0, F.col("name"))).alias("one"),
            F.coalesce(F.max(F.when(F.col("at") % 2 == 1, F.col("name"))), F.lit(0)).alias("two"),
        )
        pairs = saved(pairs.withColumn("mark", F.xxhash64("one", "two")), "pairs")
        names = _numbered(pairs.select("mark", "one", "two").distinct(), ["mark", "one", "two"])
        level = pairs.join(names, ["mark", "one", "two"])
        rounds += 1
    identity = done[0]
    for more in done[1:]:
        identity = identity.unionByName(more)
    return _same(identity, counts.select(*key, "copies"), key)


def _same(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """Join on ``key``, where a null doc_id equals another."""
    other = right.select(*[F.col(c).alias(f"__{c}") if c in key else F.col(c) for c in right.columns])
    on = [left[c].eqNullSafe(other[f"__{c}"]) if c == "doc_id" else left[c] == other[f"__{c}"] for c in key]
    return left.join(other, on).drop(*[f"__{c}" for c in key])


def _by_content(source: DataFrame, shared: DataFrame, marks: DataFrame, block: int, hash64) -> DataFrame:
    """Names where some hashes stand for several contents: these are ranked by content."""
    placed = source.select(
        "doc_id", "hash", F.sha2("bytes", 256).alias("text_sha256"), F.posexplode(_blocks(block)).alias("at", "content")
    ).withColumn("mark", hash64(F.col("content")))
    inside = placed.join(shared, "mark")
    rank = F.row_number().over(Window.partitionBy("mark").orderBy("content"))
    ranked = saved(inside.select("mark", "content").distinct().withColumn("rank", rank), "ranked")
    names = _numbered(
        marks.where("NOT shared").select("mark", F.lit(0).alias("rank")).union(ranked.select("mark", "rank")), ["mark", "rank"]
    )
    alone = placed.join(shared, "mark", "left_anti").select("doc_id", "hash", "text_sha256", "at", "mark", F.lit(0).alias("rank"))
    among = inside.join(ranked, ["mark", "content"]).select("doc_id", "hash", "text_sha256", "at", "mark", "rank")
    return alone.union(among).distinct().join(names, ["mark", "rank"])


def _groups(identity: DataFrame) -> DataFrame:
    """Per identity the row that stays: the largest doc_id, then the largest row hash; and the size of the group."""
    return identity.groupBy("rounds", "name").agg(
        F.max(F.struct("doc_id", "hash")).alias("best"), F.sum("copies").alias("group_size")
    )


def duplicates(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256 (of the normalised text).

    Texts are equal if they are identical after lower-casing A-Z; null counts as empty. Of equal texts the
    row with the largest doc_id stays (a null doc_id is the smallest); of rows that share it, one. Every input row has a
    row in the result, repeated rows too. Other columns are not looked at except to tell rows apart. An empty table gives
    an empty result.
    """
    identity = saved(named(docs, block), "identity")
    # Written first: grouping and join would share one exchange, in which a large group of copies could not be split.
    rows = identity.join(saved(_groups(identity), "groups"), ["rounds", "name"])
    first = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("hash") == F.col("best.hash"))
    return rows.select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        first.alias("__first"),
        "text_sha256",
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("__copy"),
    ).select("doc_id", "keep_id", "group_size", (F.col("__first") & (F.col("__copy") == 1)).alias("kept"), "text_sha256")


def drop_duplicates(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` that ``duplicates`` marks as kept, with all their columns."""
    identity = saved(named(docs, block), "identity")
    best = _groups(identity).select("rounds", "name", "best.doc_id", "best.hash")
    winners = _same(best, identity.select("doc_id", "hash", "copies"), ["doc_id", "hash"])
    return keep_rows(docs, saved(winners.select("doc_id", "hash", "copies"), "winners"))
