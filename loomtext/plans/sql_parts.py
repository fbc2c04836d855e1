"""Common table expressions shared by the oracle SQL (DuckDB)."""

from __future__ import annotations

from loomtext.functions.text import METASPACE, WHITESPACE
from loomtext.plans.settings import Preparation

WS = WHITESPACE
M = METASPACE
# RE2 spells the script Han without the prefix Java needs.
TOKEN = rf"{M}?\p{{Han}}+|{M}?[^\P{{L}}\p{{Han}}]+|{M}?\p{{N}}+|{M}?[^\s\p{{L}}\p{{N}}{M}]|{M}"

ARTICLES = "arts AS (SELECT 'a:' || doc_id AS row_id, 'articles' AS source_ds, text FROM documents)"
QA = """qas AS (
  SELECT 'q:' || u.conv_id || ':' || u.turn AS row_id, 'qa' AS source_ds,
         coalesce(u.text, '') || chr(10) || coalesce(a.text, '') AS text
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant' AND (u.text IS NOT NULL OR a.text IS NOT NULL))"""
CORPUS = f"{ARTICLES}, {QA}, corpus AS (SELECT * FROM arts UNION ALL SELECT * FROM qas)"
LOG = """log AS (
  SELECT user_id AS run, event_id AS step, CASE WHEN event_type = 'click' THEN value END AS loss,
         CASE WHEN event_type = 'view' THEN value END AS eval_loss FROM events)"""


def stripped(text: str = "text") -> str:
    return f"trim({text}, '{WS}')"


def shuffled(table: str, row_id: str = "row_id", seed: int = 42) -> str:
    """Positions of the seeded shuffle, as an SQL expression."""
    return f"row_number() OVER (ORDER BY md5('{seed}:' || {row_id}), {row_id}) - 1"


def normalized(mode: str) -> str:
    """The text in a normalisation. The tables hold ASCII and composed Latin letters only: NFKC leaves these alone, and
    folding them is lower(), with ß as ss if folded fully. Of the published rules' characters the tables have line ends and tabs only, which collapse anyway."""
    return {"nfkc_cf": "replace(lower(text), 'ß', 'ss')", "nmt_nfkc_cf": "lower(text)"}.get(mode, "text")


def words(source: str, out: str = "words", mode: str = "whitespace") -> str:
    """(row_id, w): the token array of each text of ``source``."""
    return f"""{out}_c AS (SELECT row_id, regexp_replace({stripped(normalized(mode))}, '[{WS}]+', ' ', 'g') AS t FROM {source}),
{out} AS (SELECT row_id, regexp_extract_all(
  CASE WHEN t = '' THEN '' ELSE '{M}' || replace(t, ' ', '{M}') END, '{TOKEN}') AS w FROM {out}_c)"""


def vocab(tokens: str, size: int) -> str:
    return f"""counts AS (SELECT tok, count(*) AS n FROM (SELECT unnest(w) AS tok FROM {tokens}) GROUP BY tok),
vocab AS (SELECT tok, n, row_number() OVER (ORDER BY n DESC, tok) + 3 AS id FROM counts
          QUALIFY row_number() OVER (ORDER BY n DESC, tok) <= {size - 4})"""


def ids(tokens: str = "words", eos: bool = True) -> str:
    """(row_id, i, id) of all tokens, with the end mark."""
    end = f" UNION ALL SELECT row_id, len(w) + 1, 3 FROM {tokens}" if eos else ""
    return f"""flat AS (SELECT row_id, unnest(w) AS tok, generate_subscripts(w, 1) AS i FROM {tokens}),
ids AS (SELECT f.row_id, f.i, coalesce(v.id, 1) AS id FROM flat f LEFT JOIN vocab v USING (tok){end})"""


def blocks(positions: str, block_size: int, batch_rows: int, keep_short: bool = False) -> str:
    """(batch, block, n, ids): packed from ``ids`` in the order of ``positions(row_id, pos)``."""
    keep = f"count(*) = {block_size}" + (" OR block = 0" if keep_short else "")
    return f"""stream AS (
  SELECT p.pos // {batch_rows} AS batch, t.id,
         row_number() OVER (PARTITION BY p.pos // {batch_rows} ORDER BY p.pos, t.i) - 1 AS k
  FROM ids t JOIN {positions} p USING (row_id)),
blocks AS (
  SELECT batch, block, count(*) AS n, string_agg(id::VARCHAR, ' ' ORDER BY k) AS ids, max(id) AS max_id
  FROM (SELECT *, k // {block_size} AS block FROM stream) GROUP BY batch, block HAVING {keep})"""


def prepared(cfg: Preparation) -> str:
    """All expressions from the sources to ``blocks`` for one parameter set."""
    if cfg.prefix_percent is None:
        rows = CORPUS if cfg.use_qa else f"{ARTICLES}, corpus AS (SELECT * FROM arts)"
    else:
        cut = f"floor((SELECT count(*) FROM documents)::DOUBLE * {cfg.prefix_percent} / 100 + 0.5)"
        rows = f"""{ARTICLES}, corpus AS (
  SELECT row_id, source_ds, text FROM (SELECT *, row_number() OVER (ORDER BY split_part(row_id, ':', 2)::BIGINT) AS r
  FROM arts) WHERE r <= {cut})"""
    pos = shuffled("corpus", seed=cfg.seed) if cfg.shuffle else (
        "row_number() OVER (ORDER BY split_part(row_id, ':', 2)::BIGINT) - 1")
    n = f"length({stripped()})"
    band = f"{n} > {cfg.length_low}" + (f" AND {n} < {cfg.length_high}" if cfg.length_high else "")
    sample = "corpus" if cfg.vocab_sample is None else (
        f"(SELECT * FROM corpus ORDER BY md5('{cfg.seed}:' || row_id), row_id LIMIT {cfg.vocab_sample})")
    return ",\n".join([
        rows,
        f"chosen AS (SELECT * FROM {sample} WHERE {band})",
        words("chosen", "train_words", cfg.normalization),
        vocab("train_words", cfg.vocab_size),
        words("corpus", mode=cfg.normalization),
        ids(eos=cfg.append_eos),
        f"positions AS (SELECT row_id, {pos} AS pos FROM corpus)",
        blocks("positions", cfg.block_size, cfg.batch_rows, cfg.keep_short),
    ])
