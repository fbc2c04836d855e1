"""The operators as registered queries over the test tables, with SQL where it can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtext.llm import conversations, exact, langid, merkle, mixing, negatives, neighbours, packing, quality, sharding, simhash, toxicity, warc
from loomtext.plans.registry import query
from loomtext.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


@query()
def op1_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return sharding.shard_documents(docs, shards=16).select(
        "doc_id",
        "size",
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query()
def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir), words=3, radius=2)


@query()
def op3_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), window=2048)


@query()
def op4_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.edited_likeness(documents(spark, sf_dir))


@query()
def op5_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.score_documents(documents(spark, sf_dir), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


@query()
def op6_tfidf_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score_documents(documents(spark, sf_dir), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted", "evidence")


WARC_SQL = r"""
    WITH numbered AS (
        SELECT page_id, coalesce(html, '') AS payload, coalesce(url, '') AS url,
               row_number() OVER (ORDER BY page_id) - 1 AS place, greatest(2048, ceil(count(*) OVER () / 8192.0)::BIGINT) AS each
        FROM pages
    ),
    records AS (
        SELECT page_id, place // each AS file, place % each AS record_no,
               'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || page_id
               || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10)
               || 'Content-Length: ' || strlen(payload) || chr(13) || chr(10) || chr(13) || chr(10) || payload AS record
        FROM numbered
    ),
    placed AS (
        SELECT *, strlen(record) AS length, sha256(record) AS expected_sha256,
               (sum(strlen(record) + 4) OVER (PARTITION BY file ORDER BY record_no))::BIGINT - strlen(record) - 4 AS "offset",
               file % 3 = 1 AND record_no = max(record_no) OVER (PARTITION BY file) AS missing
        FROM records
    ),
    found AS (
        SELECT *, CASE WHEN missing AND record_no > 0 THEN NULL
                       WHEN md5(page_id::VARCHAR)[:2] < '06' THEN record[:-2] || '#'
                       WHEN md5(page_id::VARCHAR)[:2] >= 'fd' THEN record[:-2] ELSE record END AS other
        FROM placed
    )
    SELECT file::INTEGER AS file, record_no, page_id, "offset", length, strlen(other) AS found_length,
           CASE WHEN other IS NULL THEN 'missing' WHEN strlen(other) <> length THEN 'resized' ELSE 'changed' END AS kind,
           expected_sha256, sha256(other) AS found_sha256
    FROM found WHERE other IS DISTINCT FROM record
"""


@query(WARC_SQL)
def op7_merkle_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as WARC files, an aged replica of them, and what the audit finds."""
    original, replica = scratch_path(spark, "warc"), scratch_path(spark, "warc-replica")
    warc.write_warc(warc.archive(table(spark, sf_dir, "pages")), original, exchange=False)
    records = warc.read_warc(spark, original)
    expected = warc.leaves(records)
    warc.write_warc(warc.aged(records, expected), replica, order="at", exchange=False)
    return warc.audit(expected, warc.leaves(warc.read_warc(spark, replica)))


@query()
def op8_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(documents(spark, sf_dir)).select("doc_id", "held_out", "lang_pred", "score")


MIX_SQL = r"""
    WITH sized AS (
        SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size, md5(doc_id::VARCHAR) AS h
        FROM documents
    ),
    ranked AS (
        SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
        FROM sized GROUP BY source
    ),
    weighed AS (
        SELECT *, place % 3 AS class, [5.0, 2.0, 1.0][place % 3 + 1]::DOUBLE AS weight, source_size * 2.0::DOUBLE AS most,
               (sum(source_size) OVER ())::BIGINT * 1.5::DOUBLE AS total
        FROM ranked
    ),
    levels AS (
        SELECT *, most / weight AS ratio,
               (total - coalesce(sum(most) OVER (ORDER BY most / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
               / sum(weight) OVER (ORDER BY most / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
        FROM weighed
    ),
    goals AS (
        SELECT source, source_size, class, CASE WHEN ratio <= level THEN most ELSE weight * water END AS target
        FROM (SELECT *, (SELECT level FROM levels WHERE ratio > level ORDER BY ratio, place LIMIT 1) AS water FROM levels)
    ),
    placed AS (
        SELECT s.doc_id, s.size, g.source_size, g.class, g.target,
               (sum(s.size) OVER (PARTITION BY s.source ORDER BY s.h, s.doc_id))::BIGINT - s.size AS before,
               CASE WHEN g.source_size > 0 THEN floor(g.target / g.source_size)::BIGINT ELSE 0 END AS rounds
        FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
    ),
    counted AS (
        SELECT *, CASE WHEN size > 0 THEN rounds + (before * 2 + size < (target - rounds * source_size) * 2 AND rounds < 2)::BIGINT ELSE 0 END AS copies,
               least((before + size / 2.0::DOUBLE) / target, 1) AS u
        FROM placed
    )
    SELECT doc_id, size, source_size, target, size * copies AS taken, copies,
           CASE WHEN copies = 0 THEN NULL WHEN u <= 0 THEN 0.0
                WHEN class = 0 THEN least(2 * u / (1.5::DOUBLE + sqrt(greatest(2.25::DOUBLE - 2 * u, 0))), 1)
                WHEN class = 1 THEN least(2 * u / (1 + sqrt(1)), 1)
                ELSE least(2 * u / (0.5::DOUBLE + sqrt(0.25::DOUBLE + 2 * u)), 1) END AS first_position
    FROM counted
"""


@query(MIX_SQL)
def op9_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.mix(documents(spark, sf_dir)).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        "taken",
        F.size("positions").cast("bigint").alias("copies"),
        F.get("positions", F.lit(0)).alias("first_position"),
    )
    # The id deals out the documents that the mix does not take, which have no position.
    return rows.repartitionByRange("first_position", "doc_id").sortWithinPartitions("first_position", "doc_id")


@query(
    """
    WITH t AS (
        SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
        FROM documents
    )
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept, text_sha256
    FROM t WINDOW same AS (PARTITION BY text_sha256)
    """
)
def op10_block_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.duplicates(documents(spark, sf_dir))


NEGATIVES_SQL = """
    WITH v AS (
        SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
        FROM embeddings
        WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ),
    scored AS (
        SELECT a.row AS anchor, a.vec_id AS anchor_id, b.row, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
        FROM v a JOIN v b ON a.row <> b.row AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0
    ),
    positives AS (
        SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id NULLS LAST, row) <= 5
    )
    SELECT p.anchor_id, p.vec_id AS positive_id,
           (row_number() OVER (PARTITION BY p.anchor, p.row ORDER BY n.score DESC, n.vec_id NULLS LAST, n.row))::INTEGER AS rank,
           n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
    FROM positives p JOIN scored n ON n.anchor = p.anchor AND NOT n.same
        AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
    QUALIFY row_number() OVER (PARTITION BY p.anchor, p.row ORDER BY n.score DESC, n.vec_id NULLS LAST, n.row) <= 5
"""


@query(NEGATIVES_SQL)
def op11_segment_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label")
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return negatives.mine(table(spark, sf_dir, "embeddings"), anchors=vec_id % 100 == 0, label=moved, positives=5, negatives=5, share=80)


NEIGHBOURS_SQL = """
    WITH v AS (
        SELECT row_number() OVER () AS row, vec_id, embedding::DOUBLE[] AS v
        FROM embeddings
        WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    )
    SELECT q.vec_id AS query_id, (row_number() OVER best)::INTEGER AS rank, c.vec_id, list_inner_product(q.v, c.v) AS score
    FROM v q JOIN v c ON q.row <> c.row AND len(q.v) = len(c.v)
    WHERE q.vec_id % 20 = 0
    WINDOW best AS (PARTITION BY q.row ORDER BY list_inner_product(q.v, c.v) DESC, c.vec_id NULLS LAST, c.row)
    QUALIFY row_number() OVER best <= 20
"""


@query(NEIGHBOURS_SQL)
def op12_block_matrix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), asked=F.col("vec_id") % 20 == 0, k=20)


REPAIR_SQL = r"""
    WITH RECURSIVE coded AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               xor(list_reduce(list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)::BIGINT),
                   lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
                       lambda x, bit: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END), 4294967295), 4294967295) % 20 AS what
        FROM conversations
    ),
    damaged AS (
        SELECT conv_id, turn, CASE WHEN what = 4 THEN 'user' ELSE role END AS role, role AS tie, text AS tie2, copy,
               CASE WHEN what = 1 THEN '' WHEN what = 2 THEN translate(text, '.!?', '') ELSE text END AS text
        FROM coded, range(2) AS copies(copy) WHERE what <> 0 AND (copy = 0 OR what = 3)
    ),
    numbered AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, tie, tie2, copy) AS n, left(role, 1) AS i,
               right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS last
        FROM damaged
    ),
    judged AS (
        SELECT *, CASE WHEN last = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'duplicate'
                       WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
               lag(i) OVER (PARTITION BY conv_id ORDER BY n) || i AS pair
        FROM numbered
    ),
    totals AS (
        SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
               count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
               count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(n) AS n
        FROM judged GROUP BY conv_id
    ),
    inserts(p, t, cost, letters, lines) AS (
        VALUES (0, 0, 0, '', NULL), (1, 1, 0, '', NULL), (2, 2, 0, '', NULL), (3, 3, 0, '', NULL), (0, 2, 5, 'I', 'user:'), (1, 2, 5, 'I', 'user:'),
               (2, 3, 5, 'I', 'assistant:'), (3, 2, 5, 'I', 'user:'), (0, 3, 10, 'II', 'user:' || chr(10) || 'assistant:'), (1, 3, 10, 'II', 'user:' || chr(10) || 'assistant:')
    ),
    edits(letter, t, q, cost, i, role) AS (
        VALUES ('D', 0, 0, 2, '', ''), ('D', 1, 1, 2, '', ''), ('D', 2, 2, 2, '', ''), ('D', 3, 3, 2, '', ''), ('K', 0, 1, 0, 's', ''), ('K', 0, 2, 0, 'u', ''),
               ('K', 1, 2, 0, 'u', ''), ('K', 3, 2, 0, 'u', ''), ('K', 2, 3, 0, 'a', ''), ('R', 0, 2, 1, '', 'user'), ('R', 1, 2, 1, '', 'user'),
               ('R', 3, 2, 1, '', 'user'), ('R', 2, 3, 1, '', 'assistant')
    ),
    walk AS (
        SELECT conv_id, 0::BIGINT AS n, 0 AS state, {'cost': 0::BIGINT, 'audit': '', 'made': NULL::VARCHAR} AS best FROM totals
        UNION ALL
        SELECT conv_id, n, state, min(way) AS best FROM (
            SELECT w.conv_id, j.n, e.q AS state, {
                'cost': w.best.cost + s.cost + e.cost + CASE WHEN j.fault = 'truncated' AND e.letter <> 'D' THEN 5 ELSE 0 END,
                'audit': w.best.audit || s.letters || e.letter,
                'made': nullif(concat_ws(chr(10), w.best.made, s.lines, CASE e.letter WHEN 'K' THEN j.role || ':' || j.text WHEN 'R' THEN e.role || ':' || j.text END), '')
            } AS way
            FROM walk w JOIN judged j ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.n = w.n + 1
            JOIN inserts s ON s.p = w.state
            JOIN edits e ON e.t = s.t AND (e.letter = 'D' OR j.fault NOT IN ('blank', 'duplicate') AND (e.letter = 'R' OR e.i = j.i))
        ) GROUP BY conv_id, n, state
    ),
    ended AS (
        SELECT w.conv_id, min({'cost': w.best.cost + s.cost, 'audit': w.best.audit || s.letters, 'made': concat_ws(chr(10), w.best.made, s.lines)}) AS best
        FROM walk w JOIN totals t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.n = w.n JOIN inserts s ON s.p = w.state AND s.t IN (0, 3)
        GROUP BY w.conv_id
    )
    SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
           coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0) AS cost, coalesce(best.audit, '') AS audit, sha256(coalesce(best.made, '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN totals t ON t.conv_id IS NOT DISTINCT FROM c.conv_id
    LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
"""


@query(REPAIR_SQL)
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.damaged_and_repaired(table(spark, sf_dir, "conversations"))
