"""From sources to packed blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtext.operators.encode import encode_words
from loomtext.operators.filters import keep_length_band
from loomtext.operators.order import source_positions
from loomtext.operators.pack import pack_blocks, pack_shuffled
from loomtext.operators.sample import (
    head_holdout, prefix_slice, random_holdout, sample_sentences, sample_then_filter, sentences, train_test_split,
)
from loomtext.operators.unigram import encode_unigram, unigram_vocab
from loomtext.operators.vocab import frequency_vocab, token_counts
from loomtext.plans.settings import Preparation
from loomtext.sources.corpus import unify_articles, unify_qa, union_sources


def corpus_of(articles: DataFrame, qa: DataFrame | None, cfg: Preparation) -> DataFrame:
    """Slice, unify and union the sources."""
    if cfg.prefix_percent is not None:
        articles = prefix_slice(articles, cfg.prefix_percent, "doc_id")
    parts = [unify_articles(articles)]
    if cfg.use_qa and qa is not None:
        parts.append(unify_qa(qa))
    return union_sources(*parts)


def vocabulary_of(corpus: DataFrame, cfg: Preparation) -> DataFrame:
    """Vocabulary of the sampled texts that pass the length filter."""
    if cfg.vocab_sample is None:
        chosen = keep_length_band(corpus, cfg.length_low, cfg.length_high)
    else:
        chosen = sample_then_filter(corpus, cfg.vocab_sample, cfg.length_low, cfg.length_high, cfg.seed)
    if cfg.vocab_kind == "frequency":
        return frequency_vocab(token_counts(chosen, cfg.normalization), cfg.vocab_size)
    if cfg.vocab_kind != "unigram":
        raise ValueError(f"unknown vocabulary {cfg.vocab_kind!r}")
    if cfg.sentence_cap is None:
        lines = sentences(chosen, cfg.sentence_bytes)
    else:
        lines = sample_sentences(chosen, cfg.sentence_cap, cfg.sentence_bytes, cfg.seed)
    texts = lines.select(F.col("sentence").alias("text"))
    return unigram_vocab(texts, cfg.vocab_size, cfg.coverage, cfg.normalization)


def encode(corpus: DataFrame, vocab: DataFrame, cfg: Preparation) -> DataFrame:
    """Replace ``text`` by ``input_ids`` with the vocabulary's own method."""
    method = encode_unigram if cfg.vocab_kind == "unigram" else encode_words
    return method(corpus, vocab, cfg.append_eos, cfg.normalization)


def corpus_to_blocks(articles: DataFrame, qa: DataFrame | None, cfg: Preparation) -> DataFrame:
    """The whole preparation: ``(batch, block, input_ids, labels)``.

    Texts are encoded where they are scanned, so the shuffle that orders the corpus moves ids, not text.
    """
    corpus = corpus_of(articles, qa, cfg)
    encoded = encode(corpus, vocabulary_of(corpus, cfg), cfg)
    if cfg.shuffle:
        return pack_shuffled(encoded, cfg.block_size, cfg.batch_rows, cfg.keep_short, cfg.seed)
    numbered = encoded.withColumn("doc_id", F.substring_index("row_id", ":", -1).cast("bigint"))
    return pack_blocks(source_positions(numbered, "doc_id"), cfg.block_size, cfg.batch_rows, cfg.keep_short)


def split_blocks(blocks: DataFrame, cfg: Preparation) -> tuple[DataFrame, DataFrame | None]:
    """(train, evaluation) of saved blocks. Only ``share`` takes the evaluation rows out of train."""
    named = blocks.withColumn("row_id", F.concat_ws(":", "batch", "block"))
    if cfg.holdout == "none":
        return blocks, None
    if cfg.holdout == "head":
        return blocks, head_holdout(blocks, ["batch", "block"], cfg.holdout_rows)
    if cfg.holdout == "random":
        train, held = random_holdout(named, cfg.holdout_rows, cfg.seed, exclude_from_train=False)
        return train.drop("row_id"), held.drop("row_id")
    if cfg.holdout == "share":
        parts = train_test_split(named, cfg.holdout_share, cfg.seed).drop("row_id")
        return parts.where("split = 'train'").drop("split"), parts.where("split = 'test'").drop("split")
    raise ValueError(f"unknown holdout {cfg.holdout!r}")
