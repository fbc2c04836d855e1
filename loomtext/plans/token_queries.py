"""Queries on vocabularies, encoding, packing and token statistics."""

from __future__ import annotations

from dataclasses import asdict, replace

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomtext.functions.text import collapse_whitespace, metaspace_words, normalize, tokens_of
from loomtext.operators import backoff, checks, encode, guards, ngrams, pack, sample, unigram, vocab
from loomtext.operators.order import shuffled_positions, with_position
from loomtext.plans import prepare
from loomtext.plans.registry import query
from loomtext.plans.settings import VARIANTS, Preparation, by_words
from loomtext.plans.sql_parts import CORPUS, M, WS, blocks, ids, prepared, shuffled, stripped, vocab as vocab_sql, words
from loomtext.plans.tables import articles, corpus, qa_pairs, table
from loomtext.session import ensure_checkpoint_dir, frozen, scratch_path, written
from loomtext.sources import indexed
from loomtext.sources.corpus import materialize, unify_qa
from loomtext.sources.incremental import refreshed_sums
from loomtext.sources.vocab_file import read_vocab_tsv, write_vocab_tsv

V = 32_000
BLOCK_NAME = "(batch || ':' || block)"
# Small blocks and a small vocabulary give the block queries many blocks and unknown words.
SMALL = replace(by_words(VARIANTS["published"]), append_eos=True, vocab_size=4000, block_size=64, batch_rows=100)


def ids_md5(column: str = "input_ids"):
    return F.md5(F.array_join(F.col(column).cast("array<string>"), " "))


def blocks_of(spark, sf_dir, cfg: Preparation):
    return prepare.corpus_to_blocks(articles(spark, sf_dir), qa_pairs(spark, sf_dir), cfg)


def block_rows(rows):
    return rows.select("batch", "block", F.size("input_ids").cast("bigint").alias("n"), ids_md5().alias("ids_md5"))


BLOCK_ROWS = "SELECT batch, block, n, md5(ids) AS ids_md5 FROM blocks"


def encoded(spark, sf_dir, size: int = V, eos: bool = True):
    docs = corpus(spark, sf_dir)
    return encode.encode_words(docs, vocab.frequency_vocab(vocab.token_counts(docs), size), eos)


ENCODED = ",\n".join([CORPUS, words("corpus"), vocab_sql("words", V), ids()])
ENCODED_NO_EOS = ",\n".join([CORPUS, words("corpus"), vocab_sql("words", V), ids(eos=False)])
# Next-token pairs are those the model sees: inside a block, across the texts in it.
PACKED_1024 = replace(by_words(VARIANTS["published"]), append_eos=True)
PAIRS = f"""{prepared(PACKED_1024)},
in_blocks AS (SELECT batch, block, unnest(string_split(ids, ' '))::BIGINT AS id, generate_subscripts(string_split(ids, ' '), 1) AS i FROM blocks),
pairs AS (SELECT batch, block, id AS prev, lead(id) OVER (PARTITION BY batch, block ORDER BY i) AS next FROM in_blocks),
pc AS (SELECT prev, next, count(*) AS n FROM pairs WHERE next IS NOT NULL GROUP BY prev, next)"""


@query(f"""WITH {CORPUS}, c AS (SELECT row_id, regexp_replace({stripped()}, '[{WS}]+', ' ', 'g') AS t FROM corpus),
w AS (SELECT unnest(string_split(t, ' ')) AS x FROM c WHERE t <> '')
SELECT '{M}' || x AS word, count(*) AS n FROM w GROUP BY ALL""", "metaspace_words")
def metaspace_word_counts(spark, sf_dir):
    rows = vocab.token_rows(corpus(spark, sf_dir), metaspace_words(collapse_whitespace(F.col("text"))))
    return rows.groupBy(F.col("tok").alias("word")).agg(F.count("*").alias("n"))


@query(f"""WITH {CORPUS}, {words('corpus')}
SELECT row_id, len(w) AS n, md5(array_to_string(w, chr(10))) AS tokens_md5 FROM words""")
def script_tokens(spark, sf_dir):
    rows = corpus(spark, sf_dir).select("row_id", tokens_of(F.col("text")).alias("w"))
    return rows.select("row_id", F.size("w").cast("bigint").alias("n"), F.md5(F.array_join("w", "\n")).alias("tokens_md5"))


@query(f"""WITH {CORPUS}, {words('corpus')}
SELECT tok, count(*) AS n FROM (SELECT unnest(w) AS tok FROM words) GROUP BY tok""")
def token_counts(spark, sf_dir):
    return vocab.token_counts(corpus(spark, sf_dir))


VOCAB_ROWS = f"""WITH {CORPUS}, {words('corpus')}, {vocab_sql('words', V)},
t AS (SELECT sum(n) AS total FROM vocab)
SELECT id, tok AS piece, round(ln(n::DOUBLE / total::DOUBLE), 9) AS score, false AS is_special FROM vocab, t
UNION ALL SELECT * FROM (VALUES (0, '<pad>', 0.0, true), (1, '<unk>', 0.0, true), (2, '<s>', 0.0, true),
                                (3, '</s>', 0.0, true))"""


@query(VOCAB_ROWS)
def vocab_frequency(spark, sf_dir):
    found = vocab.frequency_vocab(vocab.token_counts(corpus(spark, sf_dir)), V)
    return found.select(F.col("id").cast("bigint").alias("id"), "piece", F.round("score", 9).alias("score"), "is_special")


@query(VOCAB_ROWS)
def vocab_file_roundtrip(spark, sf_dir):
    """Write the vocabulary as tab-separated lines and rebuild the table from them."""
    path = scratch_path(spark, "vocab")
    write_vocab_tsv(vocab.frequency_vocab(vocab.token_counts(corpus(spark, sf_dir)), V), path)
    found = read_vocab_tsv(spark, path)
    return found.select(F.col("id").cast("bigint").alias("id"), "piece", F.round("score", 9).alias("score"), "is_special")


@query(f"""WITH {CORPUS}, {words('corpus')}, {vocab_sql('words', V)}
SELECT count(*) + 4 AS pieces, count(DISTINCT id) + 4 AS distinct_ids, count(DISTINCT tok) + 4 AS distinct_pieces,
       max(id) AS max_id, 4 AS special FROM vocab""")
def vocab_size_check(spark, sf_dir):
    found = checks.vocab_summary(vocab.frequency_vocab(vocab.token_counts(corpus(spark, sf_dir)), V))
    return found.withColumn("max_id", F.col("max_id").cast("bigint"))


@query(f"""WITH {CORPUS}, {words('corpus')}, {vocab_sql('words', V)}, p AS (SELECT count(*) + 4 AS pieces FROM vocab)
SELECT model_size, pieces, model_size = pieces AS fits FROM p, (VALUES ({V}), ({V} - 10), ({V} + 64)) AS m(model_size)""")
def model_vocab_check(spark, sf_dir):
    """Models of three sizes held against the vocabulary."""
    found = checks.model_fit(vocab.frequency_vocab(vocab.token_counts(corpus(spark, sf_dir)), V), [V, V - 10, V + 64])
    return found.withColumn("model_size", F.col("model_size").cast("int"))


@query(f"""WITH {ENCODED}
SELECT row_id, count(*) AS n, md5(string_agg(id::VARCHAR, ' ' ORDER BY i)) AS ids_md5 FROM ids GROUP BY row_id""")
def encode_words(spark, sf_dir):
    rows = encoded(spark, sf_dir)
    return rows.select("row_id", F.size("input_ids").cast("bigint").alias("n"), ids_md5().alias("ids_md5"))


@query(f"""WITH {ENCODED}
SELECT row_id, count(*) AS n, md5(string_agg(id::VARCHAR, ' ' ORDER BY i)) AS ids_md5 FROM ids GROUP BY row_id""")
def encode_words_joined(spark, sf_dir):
    """The same by a join with a dictionary table, as for a vocabulary that is too large to be sent to every task; hot words are dealt out."""
    docs = corpus(spark, sf_dir)
    dictionary = encode.word_dictionary(vocab.frequency_vocab(vocab.token_counts(docs), V))
    rows = encode.encode_joined(docs, dictionary, hot_rows=1000)
    return rows.select("row_id", F.size("input_ids").cast("bigint").alias("n"), ids_md5().alias("ids_md5"))


@query(f"""WITH {ENCODED}, p AS (
  SELECT f.row_id, string_agg(CASE WHEN v.id IS NULL THEN '' ELSE tok END, '' ORDER BY f.i) AS joined
  FROM flat f LEFT JOIN vocab v USING (tok) GROUP BY f.row_id)
SELECT row_id, md5(regexp_replace(replace(coalesce(joined, ''), '{M}', ' '), '^ ', '')) AS decoded_md5
FROM words LEFT JOIN p USING (row_id)""")
def decode_words(spark, sf_dir):
    docs = corpus(spark, sf_dir)
    found = encode.shared_pieces(vocab.frequency_vocab(vocab.token_counts(docs), V))
    return encode.decode(encode.encode_words(docs, found), found).select("row_id", F.md5("decoded").alias("decoded_md5"))


@query(f"""WITH {ENCODED}, p AS (
  SELECT f.row_id, string_agg(CASE WHEN v.id IS NULL THEN '' ELSE tok END, '' ORDER BY f.i) AS joined
  FROM flat f LEFT JOIN vocab v USING (tok) GROUP BY f.row_id)
SELECT row_id, md5(regexp_replace(replace(coalesce(joined, ''), '{M}', ' '), '^ ', '')) AS decoded_md5
FROM words LEFT JOIN p USING (row_id)""")
def decode_words_joined(spark, sf_dir):
    """Ids to text by a join with the pieces."""
    docs = corpus(spark, sf_dir)
    found = written(vocab.frequency_vocab(vocab.token_counts(docs), V), "vocab")  # encoding and decoding read it
    back = encode.decode_joined(encode.encode_words(docs, found), found, hot_rows=1000)
    return back.select("row_id", F.md5("decoded").alias("decoded_md5"))


@query(f"""WITH {ENCODED}, p AS (
  SELECT f.row_id, bool_or(v.id IS NULL) AS has_unknown, string_agg(tok, '' ORDER BY f.i) AS joined
  FROM flat f LEFT JOIN vocab v USING (tok) GROUP BY f.row_id)
SELECT count(*) AS texts, count(*) FILTER (coalesce(has_unknown, false)) AS with_unknown,
       count(*) FILTER (NOT coalesce(has_unknown, false) AND
         regexp_replace(replace(coalesce(joined, ''), '{M}', ' '), '^ ', '') <> words_c.t) AS mismatches
FROM words_c LEFT JOIN p USING (row_id)""")
def roundtrip_mismatches(spark, sf_dir):
    docs = corpus(spark, sf_dir)
    found = encode.shared_pieces(vocab.frequency_vocab(vocab.token_counts(docs), V))
    coded = docs.withColumn("input_ids", encode.word_ids(tokens_of(F.col("text")), found))
    unknown = F.array_contains("input_ids", vocab.UNK_ID)
    differs = F.col("decoded") != collapse_whitespace(F.col("text"))
    return encode.decode(coded, found).agg(
        F.count("*").alias("texts"), F.count_if(unknown).alias("with_unknown"), F.count_if(~unknown & differs).alias("mismatches")
    )


@query(f"""WITH {ENCODED}, p AS (SELECT row_id, string_agg(CASE WHEN v.id IS NULL THEN '<unk>' ELSE tok END, '|' ORDER BY f.i) AS shown
  FROM flat f LEFT JOIN vocab v USING (tok) GROUP BY row_id)
SELECT row_id, md5(coalesce(shown, '')) AS shown_md5 FROM words LEFT JOIN p USING (row_id)""")
def show_pieces(spark, sf_dir):
    docs = corpus(spark, sf_dir)
    shown = encode.show_pieces(docs, vocab.frequency_vocab(vocab.token_counts(docs), V))
    return shown.select("row_id", F.md5(F.array_join("pieces", "|")).alias("shown_md5"))


# The texts hold ASCII and composed Latin letters only; on these, NFKC with case folding is lower() with ß as ss.
@query(f"""WITH {CORPUS} SELECT row_id,
  md5(regexp_replace({stripped("replace(lower(text), 'ß', 'ss')")}, '[{WS}]+', ' ', 'g')) AS text_md5 FROM corpus""")
def normalize_text(spark, sf_dir):
    rows = corpus(spark, sf_dir)
    return rows.select("row_id", F.md5(normalize(F.col("text"), "nfkc_cf")).alias("text_md5"))


@query(f"""WITH {CORPUS} SELECT row_id, md5(regexp_replace({stripped("lower(text)")}, '[{WS}]+', ' ', 'g')) AS text_md5 FROM corpus""")
def normalize_published(spark, sf_dir):
    """The published rules undo what is done to the texts first: zero-width spaces for spaces, control characters, and wide letters for capitals."""
    rows = corpus(spark, sf_dir)
    capitals = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
    wide = "".join(chr(ord(c) + 0xFEE0) for c in capitals)
    odd = F.translate(F.replace("text", F.lit(" "), F.lit("\x01\u200b\x7f")), capitals, wide)
    return rows.select("row_id", F.md5(normalize(odd, "nmt_nfkc_cf")).alias("text_md5"))


PUBLISHED = VARIANTS["published"]


def published_vocab(spark, sf_dir):
    """The subword vocabulary of the published variant at its full size, trained once per session and state of the tables."""
    root = f"{ensure_checkpoint_dir(spark)}/trained"
    inputs = [f"{sf_dir}/{name}.parquet" for name in ("documents", "conversations")]
    build = lambda: prepare.vocabulary_of(corpus(spark, sf_dir), PUBLISHED)
    return materialize(spark, root, "unigram", asdict(PUBLISHED), build, inputs)


# Which pieces win is the trainer's business; SQL states what must hold of any result: its shape, the alphabet, and what
# no cut of a text can change.
BAND = f"length({stripped()}) > {PUBLISHED.length_low} AND length({stripped()}) < {PUBLISHED.length_high}"
ALPHABET = f"""{CORPUS}, chosen AS (SELECT * FROM corpus WHERE {BAND}), {words('chosen', 'train_words')},
train_chars AS (SELECT ch, count(*) AS n FROM (SELECT unnest(string_split(array_to_string(w, ''), '')) AS ch FROM train_words)
  WHERE ch <> '' GROUP BY ch),
covered AS (SELECT ch, sum(n) OVER () AS total,
  coalesce(sum(n) OVER (ORDER BY n DESC, ch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM train_chars),
alphabet AS (SELECT ch FROM covered WHERE before < total::DOUBLE * 0.9995::DOUBLE)"""


@query(f"""WITH {ALPHABET} SELECT true AS ids_dense, true AS pieces_distinct, true AS within_size, true AS scores_fall,
  4 AS special, count(*) AS alphabet FROM alphabet""")
def vocab_unigram(spark, sf_dir):
    found = published_vocab(spark, sf_dir)
    before = F.lag("score").over(Window.orderBy("id"))
    ranked = found.withColumn("falls", F.col("is_special") | F.coalesce(before >= F.col("score"), F.lit(True)) | (F.col("id") == 4))
    return ranked.agg(
        ((F.max("id") + 1 == F.count("*")) & (F.count_distinct("id") == F.count("*"))).alias("ids_dense"),
        (F.count_distinct("piece") == F.count("*")).alias("pieces_distinct"),
        (F.count("*") <= PUBLISHED.vocab_size).alias("within_size"),
        F.bool_and("falls").alias("scores_fall"),
        F.count_if("is_special").cast("int").alias("special"),
        F.count_if(~F.col("is_special") & (F.length("piece") == 1)).alias("alphabet"),
    )


# Every substring of every word, with what follows it; a seed is repeated, and no one character follows it everywhere.
@query(f"""WITH {CORPUS}, {words('corpus', mode='nfkc_cf')}, counted AS (SELECT word, count(*) AS n FROM (SELECT unnest(w) AS word FROM words) GROUP BY word),
begins AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM counted),
parts AS (SELECT word[i:i + k - 1] AS piece, word[i + k:i + k] AS after, n FROM begins, range(2, 17) AS lengths(k) WHERE i + k - 1 <= length(word)),
found AS (SELECT piece, sum(n)::BIGINT AS times FROM parts GROUP BY piece HAVING sum(n) > 1 AND (min(after) = '' OR min(after) <> max(after)))
SELECT piece, times * length(piece) AS weight FROM found ORDER BY weight DESC, piece LIMIT {10 * PUBLISHED.vocab_size}""")
def unigram_seeds(spark, sf_dir):
    """What the published subword vocabulary starts from: the repeated substrings of the words, the heaviest ten times its size."""
    found = unigram.training_words(corpus(spark, sf_dir))
    seeds = unigram.seed_pieces(found, unigram.letters_of(found), 10 * PUBLISHED.vocab_size)
    return seeds.where("NOT is_char").select("piece", "weight")


@query(f"""WITH {ALPHABET}, {words('corpus')},
toks AS (SELECT row_id, unnest(w) AS tok, generate_subscripts(w, 1) AS i FROM words),
chars AS (SELECT row_id, i, unnest(string_split(tok, '')) AS ch, generate_subscripts(string_split(tok, ''), 1) AS k FROM toks),
odd AS (SELECT row_id, i, k, a.ch IS NULL AS unknown FROM chars LEFT JOIN alphabet a USING (ch)),
runs AS (SELECT row_id, unknown AND NOT coalesce(lag(unknown) OVER (PARTITION BY row_id, i ORDER BY k), false) AS begins FROM odd),
per AS (SELECT row_id, count(*) FILTER (begins) AS unknown FROM runs GROUP BY row_id)
SELECT row_id, coalesce(unknown, 0) AS unknown, length(t) AS chars, true AS restored FROM words_c LEFT JOIN per USING (row_id)""")
def encode_unigram(spark, sf_dir):
    """Per text: unknown ids, and whether the pieces give the text back (where nothing is unknown)."""
    found = published_vocab(spark, sf_dir)
    docs = corpus(spark, sf_dir).withColumn("plain", normalize(F.col("text"), PUBLISHED.normalization)).withColumn("text", F.col("plain"))
    coded = unigram.encode_unigram(docs, found, PUBLISHED.append_eos, "none")
    back = encode.decode(coded, found)
    unknown = F.size(F.filter("input_ids", lambda i: i == vocab.UNK_ID)).cast("bigint")
    restored = (unknown > 0) | (F.col("decoded") == F.col("plain"))
    return back.select("row_id", unknown.alias("unknown"), F.length("plain").cast("bigint").alias("chars"), restored.alias("restored"))


# The survey's parameters for packing on articles and Q/A in seeded order: 64 tokens, batches of 100.
PACKED = ",\n".join([ENCODED, f"positions AS (SELECT row_id, {shuffled('corpus')} AS pos FROM corpus)"])


@query(f"WITH {PACKED}, {blocks('positions', 64, 100)} {BLOCK_ROWS}")
def pack_blocks(spark, sf_dir):
    packed = pack.pack_shuffled(encoded(spark, sf_dir), 64, 100)
    return block_rows(packed)


@query(f"""WITH {PACKED}, {blocks('positions', 64, 100)}, numbered AS (SELECT *, row_number() OVER (ORDER BY batch, block) - 1 AS block_id FROM blocks)
SELECT block_id, n, md5(ids) AS ids_md5 FROM numbered WHERE block_id IN (SELECT doc_id FROM labels)""")
def select_blocks(spark, sf_dir):
    """Blocks saved with an index and read back by number; the doc_ids of ``labels`` serve as the list."""
    packed = pack.pack_shuffled(encoded(spark, sf_dir), 64, 100)
    numbered = with_position(packed, ["batch", "block"], F.col("batch"), "block_id")
    path = scratch_path(spark, "indexed")
    indexed.save_indexed(numbered.select("block_id", "input_ids"), path, "block_id")
    found = indexed.rows_at(spark, path, "block_id", table(spark, sf_dir, "labels").select(F.col("doc_id").alias("key")))
    return found.select("block_id", F.size("input_ids").cast("bigint").alias("n"), ids_md5().alias("ids_md5"))


@query(f"""WITH docs AS (SELECT doc_id::VARCHAR AS row_id, text FROM documents WHERE doc_id % 3 <> 1 OR doc_id % 2 = 0), {words('docs')}
SELECT tok, count(*) AS n FROM (SELECT unnest(w) AS tok FROM words) GROUP BY tok""")
def token_counts_incremental(spark, sf_dir):
    """Token counts kept per file: counted once, then with one part of the folder replaced and one added; only these are read again."""
    folder, kept = scratch_path(spark, "arriving"), scratch_path(spark, "counts")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (F.col("doc_id") % 3).alias("part"))
    write = lambda rows: rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(folder)

    def counted():
        each = lambda rows: rows.select("_file", F.explode(tokens_of(F.col("text"))).alias("tok"), F.lit(1).alias("n"))
        return refreshed_sums(spark, folder, kept, each, {"tok": "string"}, ["n"])

    write(docs.where("part != 2"))
    counted()
    write(docs.where("part = 2 OR part = 1 AND doc_id % 2 = 0"))
    return counted()


@query(f"""WITH {PACKED}, {blocks('positions', 64, 100)}
SELECT count(*) AS blocks, sum(n)::BIGINT AS tokens, max(max_id)::BIGINT AS max_id, 0 AS bad_blocks, count(*) FILTER (n <> 64) AS wrong_size FROM blocks""")
def guarded_blocks(spark, sf_dir):
    """Blocks written under guard; what the guard saw in the job that wrote them."""
    path = scratch_path(spark, "guarded")
    found = guards.watched(pack.pack_shuffled(encoded(spark, sf_dir), 64, 100), guards.block_watch(V, 64), lambda rows: rows.write.parquet(path))
    names = ["blocks", "tokens", "max_id", "bad_blocks", "wrong_size"]
    row = spark.createDataFrame([tuple(int(found[n]) for n in names)], ", ".join(f"{n} bigint" for n in names))
    return row.withColumn("bad_blocks", F.col("bad_blocks").cast("int"))


@query(f"WITH {PACKED}, {blocks('positions', 2048, 2, True)} {BLOCK_ROWS}")
def pack_blocks_keep_short(spark, sf_dir):
    packed = pack.pack_blocks(shuffled_positions(encoded(spark, sf_dir)), 2048, 2, keep_short=True)
    return block_rows(packed)


@query(f"""WITH {CORPUS}, {words('corpus')}, p AS (SELECT row_id, {shuffled('corpus')} AS pos FROM corpus),
b AS (SELECT pos // 100 AS batch, sum(len(w) + 1)::BIGINT AS tokens FROM words JOIN p USING (row_id) GROUP BY 1)
SELECT batch, tokens, tokens // 64 AS blocks, tokens % 64 AS dropped FROM b""")
def packing_loss(spark, sf_dir):
    # Lengths are known before the lookup, so no vocabulary is needed.
    lengths = corpus(spark, sf_dir).select("row_id", (F.size(tokens_of(F.col("text"))) + 1).alias("n"))
    return pack.packing_loss(shuffled_positions(lengths), 64, 100)


@query(f"WITH {prepared(SMALL)} SELECT count(*) AS blocks, coalesce(sum(n), 0)::BIGINT AS tokens FROM blocks")
def block_token_totals(spark, sf_dir):
    """Totals of the saved blocks: written once, read back."""
    root = scratch_path(spark, "blocks")
    inputs = [f"{sf_dir}/{name}.parquet" for name in ("documents", "conversations")]
    saved = materialize(spark, root, "blocks", asdict(SMALL), lambda: blocks_of(spark, sf_dir, SMALL), inputs)
    return pack.block_totals(saved)


@query(f"""WITH {prepared(SMALL)}
SELECT count(*) AS blocks, max(max_id) AS max_id, count(*) FILTER (max_id >= 3990) AS bad_blocks FROM blocks""")
def token_range_check(spark, sf_dir):
    """Checked against a model that is ten ids too small, so that there is something to find."""
    found = checks.token_range(blocks_of(spark, sf_dir, SMALL), 3990)
    return found.withColumn("max_id", F.col("max_id").cast("bigint"))


@query(f"""WITH {prepared(SMALL)}
SELECT batch, block, max_id FROM blocks WHERE max_id >= 3990 ORDER BY batch, block LIMIT 5""")
def token_range_offenders(spark, sf_dir):
    found = checks.token_range_offenders(blocks_of(spark, sf_dir, SMALL), 3990)
    return found.withColumn("max_id", F.col("max_id").cast("bigint"))


@query(f"""WITH {prepared(SMALL)} SELECT count(*) AS blocks, min(n) AS min_size, max(n) AS max_size,
  count(*) FILTER (n <> 64) AS wrong_size, 0 AS wrong_labels FROM blocks""")
def block_shape_check(spark, sf_dir):
    found = checks.block_shape(blocks_of(spark, sf_dir, SMALL), 64)
    return found.select(
        "blocks", F.col("min_size").cast("bigint").alias("min_size"), F.col("max_size").cast("bigint").alias("max_size"),
        "wrong_size", "wrong_labels",
    )


@query(f"""WITH {prepared(SMALL)}, n AS (SELECT count(*) AS blocks FROM blocks)
SELECT blocks, 96 AS effective_batch, 6144 AS tokens_per_update, blocks // 96 AS steps_per_epoch,
       blocks // 96 * 2 AS total_steps, least(500, blocks // 96 * 2 // 10) AS warmup_steps FROM n""")
def run_size_plan(spark, sf_dir):
    return checks.run_size(pack.block_totals(blocks_of(spark, sf_dir, SMALL)), 24, 2, 2, block_size=64)


@query(f"""WITH {prepared(SMALL)}
SELECT batch, block, row_number() OVER (ORDER BY batch, block) - 1 AS block_id FROM blocks""")
def block_positions(spark, sf_dir):
    saved = frozen(blocks_of(spark, sf_dir, SMALL).select("batch", "block"))
    return pack.number_blocks(saved, buckets=4)


@query(f"""WITH {prepared(SMALL)}
SELECT batch, block, md5(ids) AS ids_md5 FROM blocks ORDER BY batch, block LIMIT 1000""")
def head_holdout(spark, sf_dir):
    held = sample.head_holdout(frozen(blocks_of(spark, sf_dir, SMALL)), ["batch", "block"], 1000)
    return held.select("batch", "block", ids_md5().alias("ids_md5"))


@query(f"""WITH {prepared(SMALL)}, head AS (
  SELECT batch, block, unnest(string_split(ids, ' ')[1:50])::BIGINT AS id, generate_subscripts(string_split(ids, ' ')[1:50], 1) AS i
  FROM blocks),
t AS (SELECT batch, block, string_agg(coalesce(tok, ''), '' ORDER BY i) AS joined FROM head LEFT JOIN vocab USING (id) GROUP BY ALL)
SELECT batch, block, regexp_replace(replace(joined, '{M}', ' '), '^ ', '') AS preview FROM t""")
def block_preview(spark, sf_dir):
    docs = prepare.corpus_of(articles(spark, sf_dir), qa_pairs(spark, sf_dir), SMALL)
    found = encode.shared_pieces(prepare.vocabulary_of(docs, SMALL))
    packed = pack.pack_shuffled(encode.encode_words(docs, found), SMALL.block_size, SMALL.batch_rows)
    return encode.preview_blocks(packed, found, 50).select("batch", "block", "preview")


@query(f"""WITH {prepared(SMALL)},
p AS (SELECT *, {shuffled('blocks', BLOCK_NAME)} AS pos FROM blocks)
SELECT batch, block, md5(ids) AS ids_md5, pos < 1000 AS held_out FROM p""")
def random_holdout(spark, sf_dir):
    """1,000 random blocks held out; train loses them."""
    saved = frozen(blocks_of(spark, sf_dir, SMALL).withColumn("row_id", F.concat_ws(":", "batch", "block")))
    train, held = sample.random_holdout(saved, 1000)
    both = train.withColumn("held_out", F.lit(False)).unionByName(held.withColumn("held_out", F.lit(True)))
    return both.select("batch", "block", ids_md5().alias("ids_md5"), "held_out")


@query(f"""WITH {CORPUS}, d AS (SELECT 'a:' || doc_id AS row_id, lang FROM documents),
c2 AS (SELECT row_id, source_ds, lang, text FROM corpus LEFT JOIN d USING (row_id)),
{words('corpus')}
SELECT source_ds, lang, sum(length(t))::BIGINT AS chars, sum(len(w))::BIGINT AS tokens,
       round(sum(length(t))::DOUBLE / sum(len(w))::DOUBLE, 6) AS chars_per_token
FROM c2 JOIN words USING (row_id) JOIN words_c USING (row_id) GROUP BY source_ds, lang""")
def chars_per_token(spark, sf_dir):
    """Per source and language (null for the Q/A texts): a split into characters would give 1.0."""
    docs = table(spark, sf_dir, "documents").select(F.lit("articles").alias("source_ds"), "lang", "text")
    answers = unify_qa(qa_pairs(spark, sf_dir)).select("source_ds", F.lit(None).cast("string").alias("lang"), "text")
    sized = docs.unionByName(answers).select(
        "source_ds", "lang", F.length(collapse_whitespace(F.col("text"))).alias("c"), F.size(tokens_of(F.col("text"))).alias("t")
    )
    sums = sized.groupBy("source_ds", "lang").agg(F.sum("c").alias("chars"), F.sum("t").alias("tokens"))
    return sums.withColumn("chars_per_token", F.round(F.col("chars") / F.col("tokens"), 6))


def _variant(key: str, cfg: Preparation) -> None:
    @query(f"WITH {prepared(cfg)} {BLOCK_ROWS}", name=key)
    def run(spark, sf_dir):
        return block_rows(blocks_of(spark, sf_dir, cfg))


# The published variants train subword vocabularies; with whole words in their place SQL can state every block.
for _name, _cfg in VARIANTS.items():
    _variant("corpus_to_blocks" if _name == "published" else f"corpus_to_blocks_{_name}", by_words(_cfg))


TWO_SOURCE = replace(SMALL, length_high=None, holdout="share")


@query(f"""WITH {prepared(TWO_SOURCE)},
p AS (SELECT *, {shuffled('blocks', BLOCK_NAME)} AS pos, count(*) OVER () AS n_blocks FROM blocks)
SELECT batch, block, md5(ids) AS ids_md5,
  CASE WHEN pos < ceil(n_blocks * 0.02::DOUBLE) THEN 'test' ELSE 'train' END AS split FROM p""")
def disjoint_block_split(spark, sf_dir):
    train, test = prepare.split_blocks(frozen(blocks_of(spark, sf_dir, TWO_SOURCE)), TWO_SOURCE)
    both = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    return both.select("batch", "block", ids_md5().alias("ids_md5"), "split")


@query(f"""WITH {CORPUS}, p AS (SELECT {shuffled('corpus')} AS pos FROM corpus)
SELECT pos // 2000 AS batch, count(*) AS texts, true AS balanced FROM p GROUP BY 1""")
def corpus_to_blocks_unigram(spark, sf_dir):
    """The published preparation with its subword vocabulary, by batch: whether full blocks and remainder are all tokens."""
    docs = corpus(spark, sf_dir)
    coded = frozen(prepare.encode(docs, published_vocab(spark, sf_dir), PUBLISHED))
    lengths = shuffled_positions(coded.select("row_id", F.greatest(F.size("input_ids"), F.lit(0)).alias("n")))
    size, rows = PUBLISHED.block_size, PUBLISHED.batch_rows
    texts = lengths.groupBy(F.expr(f"pos div {rows}L").alias("batch")).agg(F.count("*").alias("texts"))
    packed = pack.pack_shuffled(coded, size, rows).groupBy("batch").agg(F.count("*").alias("packed"), F.sum(F.size("input_ids")).alias("kept"))
    both = texts.join(pack.packing_loss(lengths, size, rows), "batch").join(packed, "batch", "left")
    kept = F.coalesce("kept", F.lit(0))
    balanced = (kept + F.col("dropped") == F.col("tokens")) & (F.coalesce("packed", F.lit(0)) == F.col("blocks"))
    return both.select("batch", "texts", balanced.alias("balanced"))


@query(f"WITH {PAIRS} SELECT prev, next, n FROM pc")
def next_token_pairs(spark, sf_dir):
    counts = ngrams.pair_counts(blocks_of(spark, sf_dir, PACKED_1024))
    return counts.select(F.col("prev").cast("bigint").alias("prev"), F.col("next").cast("bigint").alias("next"), "n")


@query(f"""WITH {PAIRS},
k AS (SELECT *, row_number() OVER (PARTITION BY prev ORDER BY n DESC, next) AS rank FROM pc
      QUALIFY row_number() OVER (PARTITION BY prev ORDER BY n DESC, next) <= 50),
m AS (SELECT *, pow(n::DOUBLE, 1 / 0.8::DOUBLE) AS w FROM k),
c AS (SELECT *, sum(w) OVER (PARTITION BY prev) AS total, coalesce(sum(w) OVER (
        PARTITION BY prev ORDER BY n DESC, next ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM m)
SELECT prev, next, n, rank, round(w / total, 6) AS share FROM c WHERE before < 0.95::DOUBLE * total""")
def next_token_topk_topp(spark, sf_dir):
    found = ngrams.sampling_candidates(ngrams.pair_counts(blocks_of(spark, sf_dir, PACKED_1024)), 0.8, 50, 0.95)
    return found.select(
        F.col("prev").cast("bigint").alias("prev"), F.col("next").cast("bigint").alias("next"), "n",
        F.col("rank").cast("bigint").alias("rank"), F.round("share", 6).alias("share"),
    )


@query(f"""WITH {PAIRS},
p AS (SELECT batch, block, {shuffled('blocks', BLOCK_NAME)} AS pos, count(*) OVER () AS n_rows FROM blocks),
sided AS (SELECT prev, next, pos < ceil(n_rows * 0.02::DOUBLE) AS test FROM pairs JOIN p USING (batch, block) WHERE next IS NOT NULL),
c AS (SELECT prev, next, count(*) FILTER (NOT test) AS seen, count(*) FILTER (test) AS asked FROM sided GROUP BY prev, next),
x AS (SELECT *, sum(seen) OVER (PARTITION BY prev) AS context FROM c),
l AS (SELECT sum(asked)::BIGINT AS pairs,
  sum(asked * -ln((seen + 1)::DOUBLE / (context + {V})::DOUBLE)) / sum(asked) AS ce FROM x WHERE asked > 0)
SELECT pairs, round(ce, 6) AS cross_entropy, round(exp(ce), 3) AS perplexity FROM l""")
def heldout_cross_entropy(spark, sf_dir):
    """Blocks are held out, as the published runs hold them out."""
    named = blocks_of(spark, sf_dir, PACKED_1024).select(F.concat_ws(":", "batch", "block").alias("row_id"), "input_ids")
    found = ngrams.heldout_cross_entropy(sample.train_test_split(frozen(named)), V)
    return found.select(
        "pairs", F.round("cross_entropy", 6).alias("cross_entropy"), F.round("perplexity", 3).alias("perplexity")
    )


def backoff_sql(n: int) -> str:
    """Modified Kneser-Ney of order ``n`` over ``grams(w1..wn, c, asked)``: a table, its discounts and its contexts per order, then the chain of shares."""
    ws = lambda a, b, t="": ", ".join(f"{t}w{i}" for i in range(a, b + 1))
    parts = [f"t{n} AS (SELECT {ws(1, n)}, c FROM grams WHERE c > 0)"]
    for k in range(n - 1, 0, -1):
        shorter = ", ".join(f"w{i + 1} AS w{i}" for i in range(1, k + 1))
        parts.append(f"t{k} AS (SELECT {shorter}, count(*) AS c FROM t{k + 1} GROUP BY {', '.join(f'w{i + 1}' for i in range(1, k + 1))})")
    for k in range(1, n + 1):
        parts.append(f"""n{k} AS (SELECT {", ".join(f"count(*) FILTER (c = {i})::DOUBLE AS n{i}" for i in range(1, 5))} FROM t{k}),
d{k} AS (SELECT {", ".join(f"coalesce(nullif(greatest({i} - {i + 1} * n1 / nullif(n1 + 2 * n2, 0) * n{i + 1} / nullif(n{i}, 0), 0), 0), 0.75) AS d{i}" for i in (1, 2, 3))} FROM n{k}),
s{k} AS (SELECT t{k}.*, CASE c WHEN 1 THEN d1 WHEN 2 THEN d2 ELSE d3 END AS off FROM t{k}, d{k}),
c{k} AS (SELECT {ws(1, k - 1) + "," if k > 1 else ""} sum(c)::DOUBLE AS total, sum(off) AS saved FROM s{k} {"GROUP BY " + ws(1, k - 1) if k > 1 else ""})""")
    parts.append(f"p0 AS (SELECT {ws(1, n)}, asked, 1 / {V}::DOUBLE AS p FROM grams WHERE asked > 0)")
    for k in range(1, n + 1):
        same = " AND ".join(f"s.w{i} = p.w{n - k + i}" for i in range(1, k + 1))
        context = " AND ".join(f"c.w{i} = p.w{n - k + i}" for i in range(1, k)) or "true"
        parts.append(f"""p{k} AS (SELECT {ws(1, n, "p.")}, asked, CASE WHEN total > 0 THEN (coalesce(s.c - s.off, 0) + saved * p.p) / total ELSE p.p END AS p
FROM p{k - 1} p LEFT JOIN s{k} s ON {same} LEFT JOIN c{k} c ON {context})""")
    return ",\n".join(parts)


@query(f"""WITH {PAIRS},
p AS (SELECT batch, block, {shuffled('blocks', BLOCK_NAME)} AS pos, count(*) OVER () AS n_rows FROM blocks),
runs AS (SELECT batch, block, id AS w1, lead(id) OVER b AS w2, lead(id, 2) OVER b AS w3 FROM in_blocks WINDOW b AS (PARTITION BY batch, block ORDER BY i)),
sided AS (SELECT w1, w2, w3, pos < ceil(n_rows * 0.02::DOUBLE) AS test FROM runs JOIN p USING (batch, block) WHERE w3 IS NOT NULL),
grams AS (SELECT w1, w2, w3, count(*) FILTER (NOT test) AS c, count(*) FILTER (test) AS asked FROM sided GROUP BY ALL),
{backoff_sql(3)}
SELECT sum(asked)::BIGINT AS ngrams, round(sum(-asked * ln(p)) / sum(asked), 6) AS cross_entropy FROM p3""")
def heldout_backoff_entropy(spark, sf_dir):
    """The loss of the split of ``heldout_cross_entropy`` by a model of three words with back-off."""
    named = blocks_of(spark, sf_dir, PACKED_1024).select(F.concat_ws(":", "batch", "block").alias("row_id"), "input_ids")
    found = backoff.backoff_loss(sample.train_test_split(written(named, "blocks")), V, 3)
    return found.select("ngrams", F.round("cross_entropy", 6).alias("cross_entropy"))


@query(f"""WITH {ENCODED_NO_EOS},
pairs AS (SELECT row_id, id AS prev, lead(id) OVER (PARTITION BY row_id ORDER BY i) AS next FROM ids),
s AS (SELECT row_id, 1 - count(DISTINCT (prev, next))::DOUBLE / count(*) AS share FROM pairs
      WHERE next IS NOT NULL GROUP BY row_id)
SELECT row_id, round(share, 6) AS share FROM corpus LEFT JOIN s USING (row_id)""")
def repeated_bigram_share(spark, sf_dir):
    rows = encoded(spark, sf_dir, V, eos=False)
    return rows.select("row_id", F.round(ngrams.repeated_pair_share(F.col("input_ids")), 6).alias("share"))
