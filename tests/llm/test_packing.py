import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from loomtext.llm import packing
from tests.llm.fixtures import empty_documents, odd_documents, odd_rows, with_clashes

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], dtype="<u4").tobytes()


ODD = [
    "", " ", "  a  b\n\nc\td", "<|endoftext|> x<|startoftext|>", "ΑΣ ΣΑΣ Σ é é ́a b ́", "it's don't I'LL x's 12a a1",
    "a\x0bb\x1cc d　e", "ǅ İstanbul ſtraße STRASSE", "😀👍🏽 x", "%%%&&& a%b --a- ('x')", " ' s ' t", "ß ÄÖÜ äöü Œuvre", "a​b a b", "x" * 5000,
]


def test_words_give_the_ids_of_the_whole_text(tokenizer):
    encode = packing.Encoder(tokenizer.to_str(), remembered=50)
    for text in [*ODD, None, *(r[1] for r in odd_rows() if r[1] and len(r[1]) < 5000)]:
        assert encode(text) + b"\x01\0\0\0" == ids_of(tokenizer, text), text


def check(rows, want, window):
    """Every id in one piece, offsets gapless, no sequence too long; returns the sequences' lengths."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
        assert r["ids_crc32"] == zlib.crc32(r["ids"]) and r["length"] == len(r["ids"]) // 4 > 0
    assert set(by_doc) == set(want)
    for doc, texts in want.items():
        pieces = sorted(by_doc[doc], key=lambda r: r["start"])
        if len(texts) == 1:
            assert b"".join(p["ids"] for p in pieces) == texts[0]
            assert all(p["doc_tokens"] == len(texts[0]) // 4 for p in pieces)
            assert [p["start"] for p in pieces] == list(np.cumsum([0] + [p["length"] for p in pieces[:-1]]))
        assert sum(p["length"] for p in pieces) == sum(len(t) // 4 for t in texts)
    lengths = []
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
        lengths.append(at)
    return lengths


@pytest.mark.parametrize("window", [64, 2048])
def test_odd_documents(spark, tokenizer, window):
    want = defaultdict(list)
    for r in odd_rows():
        want[r[0]].append(ids_of(tokenizer, r[1]))
    lengths = check(packing.pack(with_clashes(odd_documents(spark)), PATH, window, with_ids=True).collect(), want, window)
    # Three partitions, each with one short window at most.
    assert sum(n < window for n in lengths) <= 3


def test_the_level_with_the_least_sum_of_squares_is_taken():
    rng = random.Random(5)
    packer = packing.Packer(window=20)
    for _ in range(300):
        size = rng.randint(1, 19)
        counts = packer.counts.copy()

        def after(level):
            n = counts.copy()
            if level:
                n[level] -= 1
            if level + size < 20:
                n[level + size] += 1
            return int((n[1:] ** 2).sum())

        open_levels = [0] + [h for h in range(1, 20 - size + 1) if counts[h]]
        best = min(after(h) for h in open_levels)
        want = max(h for h in open_levels if after(h) == best)
        assert packer.level_for(size) == want
        list(packer.add(0, b"\0\0\0\0" * size))


def test_streams_of_random_documents_leave_one_short_window():
    rng = random.Random(9)
    packer, rows, total = packing.Packer(window=128), [], 0
    for doc in range(2000):
        size = rng.randint(1, 400)
        total += size
        rows += list(packer.add(doc, np.arange(size, dtype="<u4").tobytes()))
    rows += list(packer.finish())
    assert sum(r[2] for r in rows) == total and packer.next == -(-total // 128)


def test_empty_table(spark):
    assert packing.pack(empty_documents(spark), PATH).collect() == []
