"""Queries on sources, filters, samples and corpus statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomtext.functions.numeric import megabytes
from loomtext.functions.text import byte_length, preview, stripped_length
from loomtext.operators import checks, filters, order, sample, vocab
from loomtext.plans.registry import query
from loomtext.plans.sql_parts import ARTICLES, CORPUS, QA, shuffled, stripped
from loomtext.plans.tables import articles, corpus, qa_pairs, table
from loomtext.session import scratch_path
from loomtext.sources import file_order
from loomtext.sources.corpus import read_lines, unify_articles, unify_qa, write_lines

N = f"length({stripped()})"


@query("""SELECT 'documents' AS source, count(*) AS n FROM documents
UNION ALL SELECT 'conversations', count(*) FROM conversations""")
def scan_counts(spark, sf_dir):
    counts = [
        table(spark, sf_dir, t).agg(F.count("*").alias("n")).select(F.lit(t).alias("source"), "n")
        for t in ("documents", "conversations")
    ]
    return counts[0].unionByName(counts[1])


@query("""SELECT doc_id, md5(text) AS text_md5 FROM (
  SELECT *, row_number() OVER (ORDER BY doc_id) AS r, count(*) OVER () AS n FROM documents)
WHERE r <= floor(n::DOUBLE * 10 / 100 + 0.5)""")
def prefix_slice_10pct(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sample.prefix_slice(docs, 10, "doc_id").select("doc_id", F.md5("text").alias("text_md5"))


@query("""WITH placed AS (SELECT doc_id, text, row_number() OVER () AS r, count(*) OVER () AS n FROM documents)
SELECT doc_id, md5(text) AS text_md5 FROM placed WHERE r <= floor(n * 0.1::DOUBLE + 0.5)""")
def prefix_slice_by_file(spark, sf_dir):
    """The first tenth of the rows as they stand in the file, found without an id."""
    rows = file_order.first_rows(spark, f"{sf_dir}/documents.parquet", 10)
    return rows.select("doc_id", F.md5("text").alias("text_md5"))


@query("SELECT doc_id, row_number() OVER () - 1 AS pos FROM documents")
def file_position(spark, sf_dir):
    return file_order.file_positions(spark, f"{sf_dir}/documents.parquet").select("doc_id", "pos")


@query(f"WITH {ARTICLES} SELECT * FROM arts", "unify_articles")
def unify_articles_text(spark, sf_dir):
    return unify_articles(table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("completion")))


@query(f"WITH {QA} SELECT * FROM qas", "unify_qa")
def unify_qa_text(spark, sf_dir):
    return unify_qa(qa_pairs(spark, sf_dir))


@query(f"""WITH {CORPUS}
SELECT row_id, substring(text, 1, 100) AS head, substring(text, 1, 80) || '...' AS short FROM corpus""")
def text_preview(spark, sf_dir):
    text = F.col("text")
    return corpus(spark, sf_dir).select(
        "row_id", preview(text, 100).alias("head"), preview(text, 80, "...").alias("short")
    )


@query(f"""WITH {CORPUS} SELECT row_id, length(text) AS chars, {N} AS stripped_chars,
  octet_length(encode(text)) AS bytes FROM corpus""")
def text_lengths(spark, sf_dir):
    text = F.col("text")
    return corpus(spark, sf_dir).select(
        "row_id", F.length(text).cast("bigint").alias("chars"), stripped_length(text).cast("bigint").alias("stripped_chars"),
        byte_length(text).cast("bigint").alias("bytes"),
    )


@query(f"WITH {CORPUS} SELECT row_id, source_ds, md5(text) AS text_md5 FROM corpus WHERE {N} > 50")
def filter_min_len(spark, sf_dir):
    kept = filters.keep_min_length(corpus(spark, sf_dir))
    return kept.select("row_id", "source_ds", F.md5("text").alias("text_md5"))


@query(f"WITH {CORPUS} SELECT row_id, source_ds, md5(text) AS text_md5 FROM corpus WHERE {N} > 50 AND {N} < 5000")
def filter_len_band(spark, sf_dir):
    kept = filters.keep_length_band(corpus(spark, sf_dir))
    return kept.select("row_id", "source_ds", F.md5("text").alias("text_md5"))


@query(f"""WITH {CORPUS}, flagged AS (SELECT row_id, {stripped()} AS t, {N} > 50 AND {N} < 5000 AS valid FROM corpus)
SELECT row_id, valid, md5(CASE WHEN valid THEN t ELSE '' END) AS text_md5 FROM flagged""")
def flag_valid_text(spark, sf_dir):
    return filters.flag_valid(corpus(spark, sf_dir)).select("row_id", "valid", F.md5("text").alias("text_md5"))


@query(f"""SELECT conv_id, turn, nullif({stripped()}, '') AS prompt FROM conversations WHERE role = 'user'""")
def prompt_guard(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").where(F.col("role") == "user")
    return turns.select("conv_id", "turn", filters.guard_prompt(F.col("text")).alias("prompt"))


@query(f"""WITH {CORPUS}, s AS (
  SELECT row_id, unnest(string_split(text, chr(10))) AS sentence,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM corpus)
SELECT row_id, line_no, octet_length(encode(sentence)) AS bytes FROM s WHERE octet_length(encode(sentence)) <= 1024""")
def sentence_byte_filter(spark, sf_dir):
    rows = sample.sentences(corpus(spark, sf_dir), max_bytes=1024)
    return rows.select(
        "row_id", F.col("line_no").cast("bigint").alias("line_no"), byte_length(F.col("sentence")).cast("bigint").alias("bytes")
    )


@query(f"WITH {CORPUS} SELECT row_id, source_ds, md5(text) AS text_md5 FROM corpus")
def corpus_union(spark, sf_dir):
    return corpus(spark, sf_dir).select("row_id", "source_ds", F.md5("text").alias("text_md5"))


@query(f"""WITH {CORPUS} SELECT source_ds, count(*) AS texts FROM corpus GROUP BY source_ds
UNION ALL SELECT NULL, count(*) FROM corpus""")
def source_counts_rollup(spark, sf_dir):
    return checks.source_counts(corpus(spark, sf_dir))


@query(f"""WITH {CORPUS} SELECT source_ds, count(*) AS texts, count(*) FILTER ({N} > 50) AS min_length,
  count(*) FILTER ({N} > 50 AND {N} < 5000) AS in_band FROM corpus GROUP BY source_ds""")
def filter_retention(spark, sf_dir):
    return checks.retention(corpus(spark, sf_dir))


@query(f"""WITH {CORPUS}, s AS (SELECT sum(octet_length(encode(text)) + 1)::BIGINT AS bytes FROM corpus)
SELECT bytes, round(bytes / 1e6, 6) AS mb, round(bytes / 1048576.0, 6) AS mib FROM s""")
def corpus_bytes(spark, sf_dir):
    size = checks.corpus_size(corpus(spark, sf_dir))
    return size.select(
        "bytes", F.round(megabytes(F.col("bytes")), 6).alias("mb"), F.round(megabytes(F.col("bytes"), True), 6).alias("mib")
    )


@query(f"""WITH {CORPUS}
SELECT sum(len(string_split(text, chr(10))))::BIGINT AS lines, count(text) AS texts FROM corpus""")
def corpus_lines(spark, sf_dir):
    return checks.corpus_size(corpus(spark, sf_dir)).select("lines", "texts")


@query(f"""WITH {CORPUS}, kept AS (SELECT {stripped()} AS t FROM corpus WHERE {N} > 50 AND {N} < 5000),
s AS (SELECT unnest(string_split(t, chr(10))) AS sentence FROM kept)
SELECT md5(sentence) AS sentence_md5, count(*) AS n FROM s GROUP BY ALL""")
def export_lines(spark, sf_dir):
    """Write the filtered texts as lines, read the lines back."""
    path = scratch_path(spark, "export")
    flagged = filters.flag_valid(corpus(spark, sf_dir))
    write_lines(flagged.where("valid"), path)
    return read_lines(spark, path).groupBy(F.md5("sentence").alias("sentence_md5")).agg(F.count("*").alias("n"))


@query(f"WITH {ARTICLES} SELECT row_id, {shuffled('arts')} AS pos FROM arts")
def global_position(spark, sf_dir):
    return order.shuffled_positions(unify_articles(table(spark, sf_dir, "documents")).select("row_id"))


@query(f"WITH {CORPUS} SELECT row_id, {shuffled('corpus')} AS pos, md5(text) AS text_md5 FROM corpus")
def seeded_shuffle(spark, sf_dir):
    return order.shuffled_positions(corpus(spark, sf_dir)).select("row_id", "pos", F.md5("text").alias("text_md5"))


@query("SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM documents")
def source_position(spark, sf_dir):
    return order.source_positions(table(spark, sf_dir, "documents").select("doc_id"), "doc_id")


@query(f"""WITH {ARTICLES}, p AS (SELECT row_id, md5(text) AS text_md5, {shuffled('arts')} AS pos FROM arts)
SELECT * FROM p WHERE pos IN (SELECT doc_id FROM labels)""")
def select_by_position(spark, sf_dir):
    """The doc_ids of ``labels`` serve as the index list."""
    rows = unify_articles(articles(spark, sf_dir)).select("row_id", F.md5("text").alias("text_md5"))
    wanted = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("pos"))
    return sample.select_positions(order.shuffled_positions(rows), wanted)


@query(f"""WITH {CORPUS}, p AS (SELECT *, {shuffled('corpus')} AS pos FROM corpus)
SELECT row_id, md5(text) AS text_md5 FROM p WHERE pos < 500""")
def exact_sample(spark, sf_dir):
    return sample.exact_sample(corpus(spark, sf_dir), 500).select("row_id", F.md5("text").alias("text_md5"))


@query(f"""WITH {CORPUS}, p AS (SELECT *, {shuffled('corpus')} AS pos FROM corpus)
SELECT row_id, md5(text) AS text_md5 FROM p WHERE pos < 500 AND {N} > 50 AND {N} < 5000""")
def sample_then_filter(spark, sf_dir):
    return sample.sample_then_filter(corpus(spark, sf_dir), 500).select("row_id", F.md5("text").alias("text_md5"))


@query(f"""WITH {CORPUS}, p AS (SELECT *, {shuffled('corpus')} AS pos, count(*) OVER () AS n FROM corpus)
SELECT row_id, CASE WHEN pos < ceil(n * 0.02::DOUBLE) THEN 'test' ELSE 'train' END AS split FROM p""")
def train_test_split(spark, sf_dir):
    return sample.train_test_split(corpus(spark, sf_dir)).select("row_id", "split")


@query("""WITH p AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS pos, count(*) OVER () AS n FROM documents)
SELECT doc_id, pos FROM p WHERE pos % greatest(1, n // 100) = 0""")
def systematic_sample(spark, sf_dir):
    return sample.systematic_sample(table(spark, sf_dir, "documents").select("doc_id"), "doc_id")


@query(f"""WITH {CORPUS}, s AS (
  SELECT row_id, unnest(string_split(text, chr(10))) AS sentence,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM corpus),
k AS (SELECT row_id, line_no, sentence, row_id || ':' || line_no AS line_id FROM s
      WHERE octet_length(encode(sentence)) <= 2048)
SELECT line_id, md5(sentence) AS sentence_md5 FROM k ORDER BY md5('42:' || line_id), line_id LIMIT 2000""")
def sentence_subsample(spark, sf_dir):
    rows = sample.sample_sentences(corpus(spark, sf_dir), 2000, max_bytes=2048)
    return rows.select("line_id", F.md5("sentence").alias("sentence_md5"))


@query(f"""WITH {CORPUS},
c AS (SELECT ch, count(*) AS n FROM (SELECT unnest(string_split(text, '')) AS ch FROM corpus) WHERE ch <> '' GROUP BY ch),
r AS (SELECT ch, n, sum(n) OVER () AS total,
      coalesce(sum(n) OVER (ORDER BY n DESC, ch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM c)
SELECT ch, n FROM r WHERE before < total::DOUBLE * 0.9995::DOUBLE""")
def char_coverage(spark, sf_dir):
    return vocab.covering_chars(vocab.char_counts(corpus(spark, sf_dir)))
