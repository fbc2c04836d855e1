"""The published variants of corpus preparation, as parameter sets."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Preparation:
    """How a corpus becomes blocks.

    ``length_low`` and ``length_high`` select the texts the vocabulary is trained on; all texts are
    encoded. The published runs trained on samples, for they had one machine: ``prefix_percent`` of the articles, ``vocab_sample``
    texts, ``sentence_cap`` lines of at most ``sentence_bytes``. Here all of these are off unless asked for. ``holdout`` names the evaluation split: ``none``, ``share`` (disjoint), ``random`` and
    ``head`` (both taken from rows that also stay in train).
    """

    use_qa: bool = True
    prefix_percent: float | None = None
    shuffle: bool = True
    seed: int = 42
    vocab_sample: int | None = None
    length_low: int = 50
    length_high: int | None = 5000
    vocab_kind: str = "unigram"
    vocab_size: int = 32_000
    sentence_bytes: int | None = None
    sentence_cap: int | None = None
    coverage: float = 0.9995
    normalization: str = "whitespace"
    append_eos: bool = True
    block_size: int = 1024
    batch_rows: int = 2000
    keep_short: bool = False
    holdout: str = "random"
    holdout_rows: int = 1000
    holdout_share: float = 0.02


# The five variants differ in these parameters. The notebooks fold case and compatibility forms and mark the
# end of a text; the last two leave the trainer's default, and the tokenizer that packed the published corpus had neither.
VARIANTS = {
    "single_source": Preparation(
        use_qa=False, shuffle=False, length_high=None, normalization="nmt_nfkc_cf", block_size=512, batch_rows=1000, holdout="none",
    ),
    "two_source": Preparation(length_high=None, normalization="nmt_nfkc_cf", batch_rows=1000, holdout="share"),
    "dual_gpu": Preparation(normalization="nmt_nfkc_cf", batch_rows=5000, keep_short=True, holdout="head"),
    "consumer_gpu": Preparation(normalization="nmt_nfkc", batch_rows=5000, holdout="head"),
    "published": Preparation(normalization="whitespace", append_eos=False, batch_rows=2000, holdout="random"),
}

# The samples the published runs trained their vocabularies on, for ``dataclasses.replace``.
PUBLISHED_SAMPLES = {
    "single_source": {"prefix_percent": 10},
    "two_source": {"vocab_sample": 500_000, "sentence_bytes": 2048, "sentence_cap": 500_000},
    "dual_gpu": {"vocab_sample": 500_000, "sentence_bytes": 1024, "sentence_cap": 500_000},
    "consumer_gpu": {"vocab_sample": 500_000, "sentence_bytes": 4192},
    "published": {"vocab_sample": 500_000, "sentence_bytes": 4192, "sentence_cap": 200_000},
}


def by_words(cfg: Preparation) -> Preparation:
    """The same preparation with a vocabulary of whole words, whose result SQL can state row by row."""
    return replace(cfg, vocab_kind="frequency")
