import random
import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from loomtext.llm import labelled, langid, logistic, quality, toxicity
from tests.llm.fixtures import empty_documents, odd_documents, odd_rows, with_clashes

SF = "/root/testdata/sf0.1"


def table(spark, name, sf=SF):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def remainder(doc_id, parts):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % parts


# --- what the classifiers share


def test_remainders(spark):
    rows = odd_documents(spark).select("doc_id", labelled.id_remainder(F.col("doc_id"), 5).alias("r")).collect()
    assert all(r["r"] == remainder(r["doc_id"], 5) for r in rows)


def test_sample_is_bounded_whole_and_leaves_the_held_out_alone(spark):
    docs, labels = table(spark, "documents", "/root/testdata/sf0.01"), table(spark, "labels", "/root/testdata/sf0.01")
    usable = labelled.id_remainder(F.col("doc_id"), 4) != 2
    rows = labelled.sample(docs, labels, "quality", usable, 20, 5000)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert rows and max(Counter(c for _, _, c in rows).values()) <= 20
    assert all(texts[i] == t and len(t.encode()) <= 5000 and remainder(i, 4) != 2 for i, t, _ in rows)
    assert rows == labelled.sample(docs.repartition(7), labels.repartition(3), "quality", usable, 20, 5000)


def test_logistic_regression_finds_the_odds():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 2))
    y = (rng.random(4000) < logistic.sigmoid(1.5 * x[:, 0] - 0.5)).astype(float)
    weights, offset = logistic.fit(x, y, ridge=1e-6)
    assert abs(weights[0] - 1.5) < 0.2 and abs(weights[1]) < 0.15 and abs(offset + 0.5) < 0.15


# --- quality


@pytest.fixture(scope="module")
def scored_quality(spark):
    scored = quality.score_documents(table(spark, "documents"), table(spark, "labels"))
    return scored.join(table(spark, "labels"), "doc_id").select("doc_id", "held_out", "score", "predicted", "quality").collect()


def test_quality_on_held_out_rows(scored_quality):
    held = [r for r in scored_quality if r["held_out"]]
    assert all(remainder(r["doc_id"], 4) == 2 for r in held) and len(held) > 500
    assert np.mean([r["predicted"] == r["quality"] for r in held]) > 0.97
    assert np.mean([r["predicted"] for r in held if r["quality"] == 1]) > 0.98


def test_quality_score_is_calibrated(scored_quality):
    held = [r for r in scored_quality if r["held_out"]]
    assert abs(np.mean([r["score"] for r in held]) - np.mean([r["quality"] for r in held])) < 0.03
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in held)


def test_quality_features_are_compressed_sizes():
    good, bad = b"the quick brown fox jumps over the lazy dog " * 40, b"zxcv%%% qwer### " * 100
    texts = [b"", b"the quick brown fox", b"qwer### zxcv%%%", b"a" * 300_000]
    got = quality.features(texts, good, bad)
    for t, row in zip(texts, got, strict=True):
        sizes = [
            len(zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_dict_id=False).compress(t))
            for d in (good, bad)
        ]
        assert row[0] == pytest.approx((sizes[0] - sizes[1]) / (len(t) + 1))
    assert got[1][0] < 0 < got[2][0]


@pytest.mark.parametrize("labels", [[], [(1, 1), (2, 1), (3, 1)], [(0, 0), (1, 1), (None, None), (3, None)]])
def test_quality_with_few_labels_and_odd_rows(spark, labels):
    docs = with_clashes(odd_documents(spark))
    rows = quality.score_documents(docs, spark.createDataFrame(labels, "doc_id bigint, quality int")).collect()
    assert len(rows) == len(odd_rows()) and all(0 < r["score"] < 1 for r in rows)
    by_text = {}
    for r in rows:
        by_text.setdefault(r["text"] or "", set()).add(r["score"])
    assert all(len(v) == 1 for v in by_text.values())


def test_quality_of_an_empty_table(spark):
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    assert quality.score_documents(empty_documents(spark), labels).collect() == []


# --- toxicity


def random_examples(n, seed=0):
    rng = random.Random(seed)
    words = [f"word{i}" for i in range(60)]
    bad = [f"slur{i}" for i in range(8)]
    rows = []
    for i in range(n):
        c = i % 2
        text = [rng.choice(words) for _ in range(rng.randint(1, 40))] + [rng.choice(bad) for _ in range(rng.randint(1, 3) * c)]
        rng.shuffle(text)
        rows.append((i, " ".join(text), c))
    return rows


@pytest.mark.parametrize("block", [1, 7, 64])
def test_nearest_examples_are_exact(block):
    examples = random_examples(300)
    terms = sorted({t for _, text, _ in examples for w in toxicity.words_of(text) for t in toxicity._terms(w)})
    idf = np.random.default_rng(1).uniform(0.5, 3, len(terms))
    index = toxicity.Index.build(terms, idf, examples, block)
    vocabulary = toxicity.Vocabulary(terms)

    def dense(text):
        v = np.zeros(len(terms))
        for t, n in vocabulary.counts(text).items():
            v[t] = (1 + np.log(n)) * idf[t]
        return v / (np.linalg.norm(v) or 1)

    by_id = {i: dense(t) for i, t, _ in examples}
    matrix = np.array([by_id[i] for i in index.ids])
    for _, text, _ in random_examples(60, seed=5):
        at, cosine = index.nearest(vocabulary.counts(text), 10)
        want = matrix @ dense(text)
        best = np.sort(want)[::-1][:10]
        assert np.allclose(cosine, best) and np.allclose(want[at], cosine)
    assert index.nearest(Counter()) [0].size == 0


def test_blocks_out_of_reach_are_not_opened():
    examples = [(i, f"topic{i // 50} filler", i % 2) for i in range(1000)]
    terms = sorted({w for _, t, _ in examples for w in t.split()})
    index = toxicity.Index.build(terms, np.array([0.01 if t == "filler" else 1.0 for t in terms]), examples, block=25)
    index.nearest(toxicity.Vocabulary(terms).counts("topic3 filler"), 5)
    assert index.opened <= 3 < index.bounds.shape[1]


def test_terms_that_go_with_the_label_are_chosen():
    examples = random_examples(600)
    terms = toxicity.choose_terms([t for _, t, _ in examples], np.array([c for _, _, c in examples]))
    assert "slur0" in terms and "slur-" in terms and "word0" not in terms[:8]


def test_document_frequencies_count_all_documents(spark):
    got = toxicity.document_frequencies(odd_documents(spark), ["alpha", "über", "gamm-", "absent"])
    texts = [set(toxicity.words_of(r[1])) for r in odd_rows()]
    assert list(got) == [len(texts), *(sum(any(w.startswith(s) for w in t) for t in texts) for s in ("alpha", "über", "gamm")), 0]


def test_toxicity_on_held_out_rows(spark):
    docs, labels = table(spark, "documents"), table(spark, "labels")
    scored = toxicity.score_documents(docs, labels).join(labels, "doc_id").where("held_out").collect()
    insulted = [r for r in scored if r["toxic"] == 1]
    clean = [r for r in scored if r["toxic"] == 0]
    assert np.mean([r["predicted"] for r in insulted]) > 0.7
    assert np.mean([r["predicted"] for r in clean]) < 0.01
    learnt = {e["doc_id"] for r in scored for e in r["evidence"]}
    assert learnt and all(remainder(i, 5) != 0 for i in learnt)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in scored)


@pytest.mark.parametrize("labels", [[], [(0, 0), (1, 1), (2, 0), (3, 1), (100, 1), (101, 0), (None, 1), (5, None)]])
def test_toxicity_with_few_labels_and_odd_rows(spark, labels):
    rows = toxicity.score_documents(with_clashes(odd_documents(spark)), spark.createDataFrame(labels, "doc_id bigint, toxic int")).collect()
    assert len(rows) == len(odd_rows()) and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.score_documents(empty_documents(spark), spark.createDataFrame(labels, "doc_id bigint, toxic int")).collect() == []


# --- language


@pytest.mark.parametrize("chunks", [1, 3, 8192])
def test_blocked_forward_backward_is_exact(monkeypatch, chunks):
    monkeypatch.setattr(langid, "CELLS", chunks * 64)
    monkeypatch.setattr(langid, "CHUNK", 16)
    rng = np.random.default_rng(2)
    lengths = np.array([1, 16, 17, 100, 3, 47])
    scores, transitions = rng.normal(size=(lengths.sum(), 3)).astype(np.float32), rng.normal(size=(3, 3))
    got = np.concatenate([g for _, g in langid.forward_backward(scores, lengths, transitions)])
    move, at = np.exp(transitions), 0
    for n in lengths:
        psi = np.exp(scores[at : at + n].astype(float))
        alpha, beta, state = np.zeros((n, 3)), np.ones((n, 3)), np.ones(3) / 3
        for t in range(n):
            state = (state @ move) * psi[t]
            state /= state.sum()
            alpha[t] = state
        for t in range(n - 1, 0, -1):
            beta[t - 1] = move @ (beta[t] * psi[t])
            beta[t - 1] /= beta[t - 1].sum()
        want = alpha * beta
        assert np.allclose(got[at : at + n], want / want.sum(axis=1, keepdims=True), atol=1e-3)
        at += n


def test_word_features_do_not_depend_on_the_batch():
    words = ["a", "straße", "niño", "of", "abcdefghijklmnop"]
    lexicon = {"of": [0, 2]}
    rows, owners = langid.features(words, lexicon)
    together = [sorted(rows[owners == i].tolist()) for i in range(len(words))]
    alone = [sorted(langid.features([w], lexicon)[0].tolist()) for w in words]
    assert together == alone and len(together[3]) == 9  # two n-grams, four affixes, two lexicons, itself


@pytest.fixture(scope="module")
def model(spark):
    docs = table(spark, "documents", "/root/testdata/sf0.01")
    return langid.fit(docs, labelled.id_remainder(F.col("doc_id"), 4) != 2)


def test_language_on_held_out_rows(spark, model):
    docs = table(spark, "documents").where(labelled.id_remainder(F.col("doc_id"), 4) == 2)
    rows = docs.select("lang", langid.language(F.col("text"), model).alias("f")).collect()
    assert np.mean([r["lang"] == r["f"]["lang"] for r in rows]) > 0.99
    assert all(0 <= r["f"]["score"] <= 1 for r in rows)


def test_words_of_switching_text_are_labelled(spark, model):
    rows = table(spark, "documents").where("lang IN ('en', 'de') AND doc_id % 4 = 1 AND n_chars > 1500").limit(400).collect()
    one = next(r["text"] for r in rows if r["lang"] == "en").split()[:40]
    two = next(r["text"] for r in rows if r["lang"] == "de").split()[:40]
    df = spark.createDataFrame([(" ".join(one + two),)], "text string")
    words = df.select(langid.label_words(F.col("text"), model).alias("w")).first()["w"]
    cores = [langid.core(w.lower()) for w in one + two]
    assert [w["word"] for w in words] == [c for c in cores if c]
    want = ["en"] * sum(map(bool, cores[:40])) + ["de"] * sum(map(bool, cores[40:]))
    assert np.mean([w["lang"] == x for w, x in zip(words, want, strict=True)]) > 0.9


@pytest.mark.parametrize("word,want", [("abc", "abc"), ("(abc)!!", "abc"), ("x²", "x²"), ("²", ""), ("42", ""), ("_a_", "a"), ("don't", "don't"), ("½½", "")])
def test_words_start_and_end_with_letters(word, want):
    assert langid.core(word) == want


def test_language_of_odd_rows(spark):
    docs = with_clashes(odd_documents(spark))
    rows = langid.identify(docs).collect()
    assert len(rows) == len(odd_rows())
    for r in rows:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters)
    assert langid.identify(empty_documents(spark)).collect() == []
    unknown = langid.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r["lang_pred"] for r in unknown} == {"und"}


def test_unspaced_scripts_are_cut_and_whole_words_count():
    assert langid.words_of("人工智能正在改变 Welt世界ABC") == ["人工智能", "正在改变", "welt", "世界", "abc"]
    long = "x" * 100
    rows = [sorted(langid.features([w], {})[0].tolist()) for w in (long + "ing", long + "ung", long)]
    assert rows[0] != rows[1] and len(rows[0]) > len(rows[2])  # the end and all n-grams of a long word count


def test_a_text_that_changes_language_late(spark):
    han, kana = "的一是不了在人有我他这个们中来上大为和国", "あいうえおかきくけこさしすせそたちつてとなにぬねの"
    rng = random.Random(3)
    texts = [("".join(rng.choice(han) for _ in range(60)), "zh") for _ in range(30)] + [("".join(rng.choice(kana) for _ in range(60)), "ja") for _ in range(30)]
    model = langid.train(texts)
    mixed = texts[0][0][:25] + "".join(t for t, _ in texts[30:50])
    df = spark.createDataFrame([(mixed,), (texts[0][0],)], "text string")
    found = [r["f"] for r in df.select(langid.language(F.col("text"), model).alias("f")).collect()]
    assert [f["lang"] for f in found] == ["ja", "zh"]
    assert 0.9 < found[0]["score"] < 0.999 and found[1]["score"] > 0.99
    words = df.select(langid.label_words(F.col("text"), model).alias("w")).first()["w"]
    assert [w["lang"] for w in words[:6]] == ["zh"] * 6 and {w["lang"] for w in words[8:]} == {"ja"}


def test_every_language_is_learned(spark, monkeypatch):
    monkeypatch.setattr(langid, "SEQUENCES", 400)
    rng = random.Random(9)
    rows, syllables = [], [a + b for a in "bcdfghjklmnprstvwz" for b in "aeiouy"]
    for number in range(70):
        own = rng.sample(syllables, 8)
        for i in range(24):
            text = " ".join("".join(rng.choice(own) for _ in range(3)) for _ in range(40))
            rows.append((number * 1000 + i, text, f"l{number:02d}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = langid.identify(docs).where("held_out").collect()
    assert len({r["lang"] for r in found}) == 70
    assert sum(r["lang"] == r["lang_pred"] for r in found) > 0.95 * len(found)
