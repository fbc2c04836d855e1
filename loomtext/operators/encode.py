"""Text to ids and back.

Looking a word up in the vocabulary needs no shuffle: the bounded piece list is broadcast and each
Arrow batch of token arrays is mapped in one vectorised call. The join form of the same step
(``looked_up``) moves the different words of every chunk and the texts as numbers, so it is for tables that are too large to send to every task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomtext.functions.text import tokens_of, unmark
from loomtext.operators.vocab import EOS_ID, SPECIAL_PIECES, UNK_ID, TooLarge, pieces_of
from loomtext.session import written

IDS = T.ArrayType(T.IntegerType())
STRINGS = T.ArrayType(T.StringType())
# Rows of one item that are joined in one place, or that share of all rows, if it is more; so at most 10,000 items are dealt out.
HOT_ROWS, HOT_SHARE = 1_000_000, 1e-4
# Tokens of a batch that are looked up in one call; what a call makes besides its result grows with them, not with the batch.
AT_ONCE = 1 << 18
# Elements of arrays whose different items are joined together.
CHUNK = 1 << 20


def _offsets(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)


def _lengths(lists: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)


def _with_eos(ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Put the end mark behind every list."""
    borders = _offsets(lengths + 1)
    out = np.full(borders[-1], EOS_ID, np.int32)
    keep = np.ones(borders[-1], bool)
    keep[borders[1:] - 1] = False
    out[keep] = ids
    return out, borders


def shared_pieces(vocab: DataFrame | Broadcast) -> Broadcast:
    """The pieces in id order, collected once and sent to the tasks once; encoding and decoding take it in place of the table."""
    if isinstance(vocab, Broadcast):
        return vocab
    return vocab.sparkSession.sparkContext.broadcast(pa.array(pieces_of(vocab), pa.string()))


def word_ids(words: Column, vocab: DataFrame | Broadcast, append_eos: bool = True) -> Column:
    """Array of words to array of ids; unknown words become 1, the end mark 3 is optional."""
    pieces = shared_pieces(vocab)

    @F.arrow_udf(IDS)
    def lookup(lists: pa.Array) -> pa.Array:
        flat, known = lists.flatten(), pieces.value[len(SPECIAL_PIECES):]
        ids = np.empty(len(flat), np.int32)
        for at in range(0, len(flat), AT_ONCE):
            found = pc.index_in(flat.slice(at, AT_ONCE), value_set=known)
            ids[at : at + AT_ONCE] = pc.fill_null(pc.add(found, pa.scalar(len(SPECIAL_PIECES), pa.int32())), UNK_ID).to_numpy()
        lengths = _lengths(lists)
        ids, borders = _with_eos(ids, lengths) if append_eos else (ids, _offsets(lengths))
        return pa.ListArray.from_arrays(pa.array(borders), pa.array(ids, pa.int32()), mask=lists.is_null())

    return lookup(words)


def _numbered(items: Column, kind: T.DataType) -> Column:
    """Per array ``(chunk, places, base, fresh)``: the places of its elements among the different items of its chunk, a run of rows of one task with about ``CHUNK`` elements.

    Items that are new in the chunk stand in ``fresh`` of one row, from place ``base`` on. A null element has a null place, a null array null places.
    """
    result = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("places", IDS), T.StructField("base", T.IntegerType()), T.StructField("fresh", T.ArrayType(kind))])
    size, at_once = CHUNK, AT_ONCE

    @F.arrow_udf(result)
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        chunk, room, held = TaskContext.get().partitionId() << 33, size, None
        for lists in batches:
            flat, borders = lists.flatten(), np.concatenate([[0], np.cumsum(_lengths(lists), dtype=np.int64)])
            held = flat.slice(0, 0) if held is None else held
            chunks, bases, fresh, places, row = [], [], [], np.zeros(len(flat), np.int32), 0
            while row < len(lists):
                if room <= 0:
                    chunk, room, held = chunk + 1, size, held.slice(0, 0)
                # As many rows as there is room for, but one at least.
                last = max(row + 1, int(np.searchsorted(borders, borders[row] + room, side="right")) - 1)
                base = len(held)
                for at in range(borders[row], borders[last], at_once):
                    part = flat.slice(at, min(at_once, borders[last] - at)).dictionary_encode()
                    found = pc.index_in(part.dictionary, value_set=held)
                    new = part.dictionary.filter(found.is_null())
                    number = found.fill_null(0).to_numpy().copy()
                    number[found.is_null().to_numpy(zero_copy_only=False)] = len(held) + np.arange(len(new))
                    held = pa.concat_arrays([held, new])
                    if len(number):
                        places[at : at + len(part)] = number[pc.fill_null(part.indices, 0).to_numpy()]
                chunks += [chunk] * (last - row)
                bases += [base] + [None] * (last - row - 1)
                fresh += [held.slice(base)] + [held.slice(0, 0)] * (last - row - 1)
                room -= int(borders[last] - borders[row])
                # The next row would go beyond the chunk.
                room, row = room if last == len(lists) else 0, last
            whole = pa.array(places, mask=flat.is_null().to_numpy(zero_copy_only=False) if flat.null_count else None)
            columns = [
                pa.array(chunks, pa.int64()), pa.ListArray.from_arrays(pa.array(borders.astype(np.int32)), whole, mask=lists.is_null()), pa.array(bases, pa.int32()),
                pa.ListArray.from_arrays(pa.array(_offsets(np.fromiter(map(len, fresh), np.int64, len(fresh)))), pa.concat_arrays(fresh or [held.slice(0, 0)])),
            ]
            yield pa.StructArray.from_arrays(columns, ["chunk", "places", "base", "fresh"])
            del flat, places, whole, columns, fresh
            pa.default_memory_pool().release_unused()  # before the next batch is read

    return of(items)


def looked_up(df: DataFrame, key: str, items: Column, table: DataFrame, hot_rows: int = HOT_ROWS, left_out: str = "", restored: str = "") -> DataFrame:
    """``df`` with ``_values``: the elements of the array ``items``, each replaced by its ``value`` in ``table(item, value)``, null where it has none.

    The column ``left_out`` is not kept; the column ``restored`` is ``items`` itself and is made again from its places.
    A join, for tables of any size. Rows are taken in chunks of about ``CHUNK`` elements; only the different items of a chunk are joined, and what they give comes back to the chunk. The arrays
    are made and written once, as places among these items. An item in over ``hot_rows`` chunks (or ``HOT_SHARE`` of all that is joined, if that is more) is dealt to
    several places, as its table row is; at most the inverse of that share are, and only their hashes and numbers of places are broadcast. ``item`` names the rows of the table uniquely.
    A null array stays null. ``key`` names the rows of ``df``: those that share one become one row, with the elements of all by place.
    """
    # The columns travel under plain names, as a grouping takes no others.
    inner = {c: "_restored" if c == restored else f"_column{i}" for i, c in enumerate(df.columns) if c != left_out}
    wanted, names = [F.col(n).alias(c) for c, n in inner.items()], [n for c, n in inner.items() if c != restored]
    own = {c: F.col("`" + c.replace("`", "``") + "`") for c in inner}
    given = [own[c].alias(n) for c, n in inner.items() if c != restored]
    kind = df.select(items.alias("_items")).schema["_items"].dataType.elementType
    kept = written(df.withColumn("_code", _numbered(items, kind)).select(*given, F.col(key).alias("_key"), *[F.col(f"_code.{c}").alias(f"_{c}") for c in ("chunk", "places", "base", "fresh")]), "items")
    each = kept.where("_base IS NOT NULL").select("_chunk", "_base", F.posexplode("_fresh").alias("_at", "item")).select("_chunk", (F.col("_base") + F.col("_at")).alias("_place"), "item")
    total = kept.agg(F.coalesce(F.sum(F.size("_fresh")), F.lit(0))).scalar()
    most = F.greatest(F.lit(hot_rows), F.ceil(total * HOT_SHARE))
    chunks = kept.agg(F.count_distinct("_chunk")).scalar()  # no item has more rows
    counts = each.where(chunks > most).groupBy(F.xxhash64("item").alias("_hash")).agg(F.count("*").alias("n"))
    hot = F.broadcast(counts.where(F.col("n") > most).select("_hash", F.ceil(F.col("n") / most).alias("_places")))
    places = F.coalesce("_places", F.lit(1))
    ours = each.withColumn("_hash", F.xxhash64("item")).join(hot, "_hash", "left").withColumn("_salt", F.pmod(F.xxhash64("_chunk", "_place"), places))
    theirs = table.withColumn("_hash", F.xxhash64("item")).join(hot, "_hash", "left")
    theirs = theirs.select("item", "value", F.explode(F.sequence(F.lit(0).cast("bigint"), places - 1)).alias("_salt"))
    found = ours.join(theirs, ["item", "_salt"], "left").select("_chunk", "_place", F.col("value").alias("_value"), *[F.col("item").alias("_item")] * bool(restored))
    rows = kept.select(*names, F.col("_chunk").alias("_chunk"), "_places")

    def put(ours: pa.Table, theirs: pa.Table) -> pa.Table:
        theirs, whole = theirs.sort_by("_place"), ours.select(names)
        for name, source in made:
            values = pa.concat_arrays([pa.array([], theirs.schema.field(source).type), *theirs.column(source).chunks])
            parts = [pa.ListArray.from_arrays(pa.array(_offsets(_lengths(x))), values.take(x.flatten()), mask=x.is_null()) for x in ours.column("_places").chunks]
            whole = whole.append_column(name, pa.chunked_array(parts, pa.list_(values.type)))
        return whole

    made = [("_restored", "_item")] * bool(restored) + [("_values", "_value")]
    kinds = {"_item": kind, "_value": table.schema["value"].dataType}
    schema = T.StructType([*rows.select(*names).schema.fields, *(T.StructField(name, T.ArrayType(kinds[source])) for name, source in made)])
    each_once = rows.groupBy("_chunk").cogroup(found.groupBy("_chunk")).applyInArrow(put, schema).select(*wanted, "_values")
    if kept.groupBy("_key").count().where("count > 1").isEmpty():
        return each_once
    placed = F.transform("_values", lambda x, i: F.struct(i.alias("_place"), x.alias("value")))
    merged = each_once.groupBy(F.col(key).alias("_key")).agg(
        F.first(F.struct(*own.values())).alias("_row"), F.sort_array(F.flatten(F.collect_list(placed))).alias("_all"), F.bool_or(F.col("_values").isNull()).alias("_none")
    )
    return merged.select("_row.*", F.when(~F.col("_none"), F.transform("_all", lambda x: x["value"])).alias("_values"))


def encode_joined(docs: DataFrame, dictionary: DataFrame, append_eos: bool = True, mode: str = "whitespace", key: str = "row_id", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Replace ``text`` by ``input_ids`` through a table ``(item, value)`` of words and their ids; a word without a row is unknown."""
    found = looked_up(docs, key, tokens_of(F.col("text"), mode), dictionary, hot_rows, left_out="text")
    ids = F.flatten(F.transform("_values", lambda v: F.coalesce(v, F.array(F.lit(UNK_ID)))))
    ended = F.concat(ids, F.array(F.lit(EOS_ID))) if append_eos else ids
    return found.withColumn("input_ids", ended.cast(IDS)).drop("_values")


def word_dictionary(vocab: DataFrame) -> DataFrame:
    """``(item, value)``: every piece that is a word, with its id as an array."""
    return vocab.where(~F.col("is_special")).select(F.col("piece").alias("item"), F.array(F.col("id").cast("int")).alias("value"))


def encode_words(docs: DataFrame, vocab: DataFrame | Broadcast, append_eos: bool = True, mode: str = "whitespace", key: str = "row_id") -> DataFrame:
    """Replace ``text`` by ``input_ids``. No truncation, no mask. A vocabulary too large for a broadcast is joined by ``key``, which must name the rows uniquely."""
    try:
        vocab = shared_pieces(vocab)
    except TooLarge:
        return encode_joined(docs, word_dictionary(vocab), append_eos, mode, key)
    ids = word_ids(tokens_of(F.col("text"), mode), vocab, append_eos)
    return docs.withColumn("input_ids", ids).drop("text")


def id_pieces(ids: Column, vocab: DataFrame | Broadcast, keep_special: bool = False, joined: bool = False) -> Column:
    """Array of ids to array of pieces, or to all of them in one text. Special ids, and ids outside the vocabulary, are skipped."""
    pieces = shared_pieces(vocab)
    lowest = 0 if keep_special else len(SPECIAL_PIECES)

    @F.arrow_udf(T.StringType() if joined else STRINGS)
    def lookup(lists: pa.Array) -> pa.Array:
        flat, lengths, values = lists.flatten(), _lengths(lists), pieces.value
        ends, kept, taken = np.cumsum(lengths, dtype=np.int64), np.zeros(len(lengths), np.int64), []
        for at in range(0, len(flat), AT_ONCE):
            ids = pc.fill_null(flat.slice(at, AT_ONCE), -1).to_numpy(zero_copy_only=False)
            known = np.flatnonzero((ids >= lowest) & (ids < len(values)))
            # The rows these ids lie in; only rows that end or begin here are counted.
            first, last = np.searchsorted(ends, [at, at + len(ids) - 1], side="right")
            borders = np.clip(ends[first : last + 1] - at, 0, len(ids))
            kept[first : last + 1] += np.diff(np.searchsorted(known, borders), prepend=0)
            taken.append(values.take(pa.array(ids[known])))
        whole = pa.concat_arrays(taken) if taken else pa.array([], pa.string())
        pieces_of_rows = pa.ListArray.from_arrays(pa.array(_offsets(kept)), whole, mask=lists.is_null())
        return pc.binary_join(pieces_of_rows, "") if joined else pieces_of_rows

    return lookup(ids)


def decode(df: DataFrame, vocab: DataFrame | Broadcast, key: str = "row_id") -> DataFrame:
    """Add ``decoded``: the pieces joined, marks turned into spaces, special ids left out. A vocabulary too large for a broadcast is joined by ``key``."""
    try:
        vocab = shared_pieces(vocab)
    except TooLarge:
        return decode_joined(df, vocab, key)
    return df.withColumn("decoded", unmark(id_pieces(F.col("input_ids"), vocab, joined=True)))


def decode_joined(df: DataFrame, vocab: DataFrame, key: str = "row_id", hot_rows: int = HOT_ROWS) -> DataFrame:
    """``decode`` by a join of the ids with the pieces."""
    pieces = vocab.where(~F.col("is_special")).select(F.col("id").alias("item"), F.col("piece").alias("value"))
    found = looked_up(df, key, F.col("input_ids"), pieces, hot_rows, restored="input_ids")
    return found.withColumn("decoded", unmark(F.array_join("_values", ""))).drop("_values")


def preview_blocks(blocks: DataFrame, vocab: DataFrame | Broadcast, first: int = 50) -> DataFrame:
    """Add ``preview``: the text of the first ids of each block."""
    head = blocks.withColumn("_ids", F.slice("input_ids", 1, first))
    return head.withColumn("preview", unmark(F.array_join(id_pieces(F.col("_ids"), vocab), ""))).drop("_ids")


def show_pieces(docs: DataFrame, vocab: DataFrame | Broadcast, mode: str = "whitespace") -> DataFrame:
    """Add ``pieces``: how a text is cut, with ``<unk>`` where a word is unknown."""
    vocab = shared_pieces(vocab)
    ids = word_ids(tokens_of(F.col("text"), mode), vocab, append_eos=False)
    return docs.withColumn("pieces", id_pieces(ids, vocab, keep_special=True))
