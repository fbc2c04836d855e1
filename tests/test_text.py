import unicodedata

import pytest
import sentencepiece
from pyspark.sql import functions as F

from loomtext.functions import text as t

SAMPLES = [
    "", " ", "　　", "a", "　 a 　", "\x1c x \x85", "AI智能 2024年,，!", "é\nß  b", "😀 b", "ＡＢＣ①", "a b",
    "人工智能正在改变世界", "x▁y", "don't  stop\t\r\n", "٣٤ abc",
]


def column(spark, expr, values=SAMPLES):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, text string")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_whitespace_set_is_pythons():
    assert t.WHITESPACE == "".join(chr(c) for c in range(0x110000) if chr(c).isspace())


def test_strip_and_lengths(spark):
    x = F.col("text")
    assert column(spark, t.strip_text(x)) == [s.strip() for s in SAMPLES]
    assert column(spark, t.stripped_length(x)) == [len(s.strip()) for s in SAMPLES]
    assert column(spark, F.length(x)) == [len(s) for s in SAMPLES]
    assert column(spark, t.byte_length(x)) == [len(s.encode()) for s in SAMPLES]


def test_collapse_whitespace(spark):
    assert column(spark, t.collapse_whitespace(F.col("text"))) == [" ".join(s.split()) for s in SAMPLES]


def test_every_space_character_is_collapsed(spark):
    values = [f"a{c}b" for c in t.WHITESPACE]
    assert column(spark, t.collapse_whitespace(F.col("text")), values) == ["a b"] * len(values)


def test_question_answer(spark):
    df = spark.createDataFrame([("q", "a"), (None, "a"), ("q", None), (None, None)], "q string, a string")
    got = [r[0] for r in df.select(t.join_question_answer(F.col("q"), F.col("a"))).collect()]
    assert got == ["q\na", "\na", "q\n", None]


def test_preview(spark):
    assert column(spark, t.preview(F.col("text"), 4)) == [s[:4] for s in SAMPLES]
    assert column(spark, t.preview(F.col("text"), 4, "...")) == [s[:4] + "..." for s in SAMPLES]


@pytest.mark.parametrize("mode", ["nfkc", "nfkc_cf"])
def test_normalize(spark, mode):
    def want(s):
        s = unicodedata.normalize("NFKC", s)
        if mode == "nfkc_cf":
            s = unicodedata.normalize("NFKC", s.casefold())
        return " ".join(s.split())

    assert column(spark, t.normalize(F.col("text"), mode), [*SAMPLES, None]) == [*[want(s) for s in SAMPLES], None]


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nmt_nfkc_cf"])
def test_published_normalisation_of_every_character(spark, rule):
    """Against the public normaliser, on every character alone between letters; a few are newer than one of the two Unicode tables."""
    published = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=False, escape_whitespaces=False, remove_extra_whitespaces=False)
    known = [c for c in range(1, 0x20000) if unicodedata.category(chr(c)) not in ("Cn", "Cs", "Co")]
    samples = [f"x {chr(c)} y" for c in known]
    got = column(spark, t.normalize(F.col("text"), rule), samples)
    want = [" ".join(published.normalize(s).split()) for s in samples]
    odd = [hex(c) for c, a, b in zip(known, got, want, strict=True) if a != b and a.split() != b.split()]
    assert len(odd) <= 12, odd
    assert not {hex(ord(c)) for c in t.NMT_SPACES + t.NMT_REMOVED + t.FULL_TILDE + "ßẞﬁＡ㍿"} & set(odd)


def test_published_rules_between_letters(spark):
    published = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc_cf", add_dummy_prefix=False, escape_whitespaces=False, remove_extra_whitespaces=False)
    samples = [f"A{c}b" for c in t.NMT_SPACES + t.NMT_REMOVED + t.FULL_TILDE] + ["Straße ǅ e\u0301 ﬁn Ａ～Ｂ", "Ｈello\u200bＷorld\x01!", "ÀÉ “Quote” – 智能。", "½ ² ™"]
    got = column(spark, t.normalize(F.col("text"), "nmt_nfkc_cf"), samples)
    assert got == [" ".join(published.normalize(s).split()) for s in samples]
    assert column(spark, t.nmt_rules(F.col("text")), ["a\x00b", None, ""]) == ["a\x00b", None, ""]


def test_characters_that_stay_in_the_jvm_are_stable():
    import re

    stable = [chr(c) for c in range(0x10000) if re.match(f"[{t.STABLE}]", chr(c))]
    assert all(unicodedata.normalize("NFKC", c) == c for c in stable)
    assert all(unicodedata.normalize("NFKC", c.casefold()) == c.lower() and len(c.lower()) == 1 for c in stable)
    assert not any(unicodedata.combining(c) for c in stable)


def test_unknown_normalisation():
    with pytest.raises(ValueError):
        t.normalize(None, "nfd")


def test_metaspace(spark):
    x = F.col("text")
    assert column(spark, t.metaspace(x), ["", "a", "a b", " a", "a  b"]) == ["", "▁a", "▁a▁b", "▁▁a", "▁a▁▁b"]
    assert column(spark, t.metaspace_words(x), ["", "a", "a b", "a  b"]) == [
        [], ["▁a"], ["▁a", "▁b"], ["▁a", "▁", "▁b"]]


def test_tokens_split_scripts_and_digits(spark):
    got = column(spark, t.tokens_of(F.col("text")), ["AI智能 2024年,，!", "don't", "a😀b", "", "x-1 y"])
    assert got == [
        ["▁AI", "智能", "▁2024", "年", ",", "，", "!"],
        ["▁don", "'", "t"], ["▁a", "😀", "b"], [], ["▁x", "-", "1", "▁y"],
    ]


def test_tokens_lose_nothing(spark):
    joined = column(spark, F.array_join(t.tokens_of(F.col("text")), ""))
    assert joined == ["".join("▁" + w for w in s.split()) for s in SAMPLES]
    back = column(spark, t.unmark(F.array_join(t.tokens_of(F.col("text")), "")))
    assert back == [" ".join(s.split()).replace("▁", " ") for s in SAMPLES]
