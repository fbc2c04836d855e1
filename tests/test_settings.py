"""The variants as published, and what their parameters do."""

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from loomtext.operators import encode, vocab
from loomtext.operators.series import last_known
from loomtext.plans import prepare
from loomtext.plans.settings import PUBLISHED_SAMPLES, VARIANTS, by_words

# Variant: Q/A used, normalisation, end mark, block size, batch rows, short blocks kept, holdout.
WANT = {
    "single_source": (False, "nmt_nfkc_cf", True, 512, 1000, False, "none"),
    "two_source": (True, "nmt_nfkc_cf", True, 1024, 1000, False, "share"),
    "dual_gpu": (True, "nmt_nfkc_cf", True, 1024, 5000, True, "head"),
    "consumer_gpu": (True, "nmt_nfkc", True, 1024, 5000, False, "head"),
    "published": (True, "whitespace", False, 1024, 2000, False, "random"),
}


def test_variants_have_the_published_settings():
    found = {
        n: (c.use_qa, c.normalization, c.append_eos, c.block_size, c.batch_rows, c.keep_short, c.holdout) for n, c in VARIANTS.items()
    }
    assert found == WANT
    assert all(c.vocab_kind == "unigram" and c.vocab_size == 32_000 and c.coverage == 0.9995 for c in VARIANTS.values())


def test_all_rows_count_unless_a_sample_is_asked_for():
    for cfg in VARIANTS.values():
        assert (cfg.vocab_sample, cfg.sentence_cap, cfg.sentence_bytes, cfg.prefix_percent) == (None,) * 4
    for name, sample in PUBLISHED_SAMPLES.items():
        assert all(getattr(replace(VARIANTS[name], **sample), k) == v for k, v in sample.items())


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(f"a:{i}", "articles", f"text number {i} " + "with enough words to pass the length filter " * 2) for i in range(200)]
    return spark.createDataFrame(rows, "row_id string, source_ds string, text string")


def test_an_explicit_sample_trains_on_so_many_texts(corpus):
    whole = prepare.vocabulary_of(corpus, by_words(VARIANTS["published"]))
    few = prepare.vocabulary_of(corpus, replace(by_words(VARIANTS["published"]), vocab_sample=20))
    assert whole.count() - few.count() == 180


def test_a_vocabulary_is_collected_once_for_encoding_and_decoding(spark, corpus, monkeypatch):
    calls = []
    monkeypatch.setattr(encode, "pieces_of", lambda v: calls.append(1) or vocab.pieces_of(v))
    found = encode.shared_pieces(vocab.frequency_vocab(vocab.token_counts(corpus), 500))
    back = encode.decode(encode.encode_words(corpus, found), found)
    shown = encode.show_pieces(corpus, found)
    assert back.count() == shown.count() == 200 and len(calls) == 1


def test_pieces_are_bounded_in_bytes(spark, monkeypatch):
    monkeypatch.setattr(vocab, "MAX_BYTES", 10)
    rows = spark.createDataFrame([(0, "x" * 20)], "id int, piece string")
    with pytest.raises(ValueError, match="bytes"):
        vocab.pieces_of(rows)


@pytest.mark.parametrize("fan", [2, 3, 1000])
@pytest.mark.parametrize("span", [1, 7])
def test_values_are_carried_over_spans_of_spans(spark, span, fan):
    rng = random.Random(span * fan)
    rows = [(i, rng.randint(0, 9) if rng.random() < 0.05 else None) for i in range(400) if rng.random() < 0.7]
    df = spark.createDataFrame(rows, "step long, v int")
    last, want = None, {}
    for step, v in rows:
        last = v if v is not None else last
        want[step] = last
    got = last_known(df, F.col("v"), ["step"], "known", span=span, fan=fan).collect()
    assert {r["step"]: r["known"] for r in got} == want
