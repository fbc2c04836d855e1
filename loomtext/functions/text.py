"""Text expressions. All but ``normalize`` of unusual characters are built-in functions and stay inside the JVM."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters Python's str.strip() removes, in code point order.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Fixed value: the mark that stands for a space in subword pieces.
METASPACE = "▁"

# The same set as a Java pattern; a class of single characters would be three times slower.
WHITESPACE_RUN = r"(?U)[\s\x1c-\x1f]+"

# The characters the published normalisation takes for a space, those it removes, and the one NFKC must not change.
NMT_SPACES = "\t\n\x0c\r\u061c\u1680\u200b\u200c\u200e\u200f\u2028\u2029\u2581\ufeff\ufffd"
NMT_REMOVED = (
    "\x01\x02\x03\x04\x05\x06\x07\x08\x0b\x0e\x0f\x10\x11\x12\x13\x14\x15\x16\x17\x18\x19\x1a\x1b\x1c\x1d\x1e\x1f\x7f\x8f\x9f"
)
FULL_TILDE = "\uff5e"

# Characters that NFKC leaves alone next to one another, and that folding only lower-cases: ASCII, composed letters of Western Europe,
# common quotes and dashes, ideographs and their stops.
STABLE = (
    "\x00-\x7f\u00c0-\u00d6\u00d8-\u00de\u00e0-\u00f6\u00f8-\u00ff\u00ab\u00bb\u2013\u2014\u2018-\u201d\u20ac\u3001\u3002\u4e00-\u9fff"
)

# One alternative per script class; together they tile every text that has no whitespace left.
SCRIPT_TOKEN = METASPACE + r"?(?:[\p{L}&&\P{IsHan}]+|\p{IsHan}+|\p{N}+|[^\s\p{L}\p{N}" + METASPACE + "])|" + METASPACE


def strip_text(text: Column) -> Column:
    """Remove Unicode whitespace at both ends."""
    return F.btrim(text, F.lit(WHITESPACE))


def stripped_length(text: Column) -> Column:
    """Code points left after stripping."""
    return F.length(strip_text(text))


def byte_length(text: Column) -> Column:
    return F.octet_length(text)


def join_question_answer(question: Column, answer: Column) -> Column:
    """Question, newline, answer. A null side counts as empty; both null gives null."""
    empty = F.lit("")
    return F.when(
        question.isNotNull() | answer.isNotNull(),
        F.concat(F.coalesce(question, empty), F.lit("\n"), F.coalesce(answer, empty)),
    )


def preview(text: Column, chars: int = 100, tail: str = "") -> Column:
    """First ``chars`` code points, followed by ``tail``."""
    head = F.substring(text, 1, chars)
    return F.concat(head, F.lit(tail)) if tail else head


def lines_of(text: Column) -> Column:
    return F.split(text, "\n")


def collapse_whitespace(text: Column) -> Column:
    """Strip, then turn each inner run of whitespace into one space."""
    return F.regexp_replace(strip_text(text), WHITESPACE_RUN, " ")


def simple_fold(char: str) -> str:
    """Case folding of one character to one character; a character whose folding is longer is lower-cased if that is one, or stays."""
    for folded in (char.casefold(), char.lower()):
        if len(folded) == 1:
            return folded
    return char


# Filled where it is needed: a cached function would not travel to the executors by value.
_FOLDS: dict[int, str] = {}


def _folds() -> dict[int, str]:
    if not _FOLDS:
        _FOLDS.update({c: f for c in range(0x20000) if (f := simple_fold(chr(c))) != chr(c)})
    return _FOLDS


def _composed(text: str, fold: str) -> str:
    """NFKC, with case folded by ``full``, ``simple`` or no rule, and composed again, as folding can undo the composition."""
    text = unicodedata.normalize("NFKC", text)
    if not fold:
        return text
    return unicodedata.normalize("NFKC", text.casefold() if fold == "full" else text.translate(_folds()))


def _nfkc(text: Column, fold: str, kept: str = "") -> Column:
    @F.pandas_udf(T.StringType())
    def of(texts: pd.Series) -> pd.Series:
        parts = lambda t: kept.join(_composed(p, fold) for p in t.split(kept)) if kept else _composed(t, fold)
        return texts.map(parts, na_action="ignore")

    return of(text)


def nmt_rules(text: Column) -> Column:
    """Control characters go, and what the published rules take for a space becomes one; texts without any are left as they are."""
    ruled = F.translate(text, NMT_SPACES + NMT_REMOVED, " " * len(NMT_SPACES))
    return F.when(text.rlike(f"[{NMT_SPACES}{NMT_REMOVED}]"), ruled).otherwise(text)


def normalize(text: Column, mode: str = "nfkc_cf") -> Column:
    """Unicode normalisation followed by whitespace collapse.

    ``nmt_nfkc`` and ``nmt_nfkc_cf`` are the rules of the published trainer: those of ``nmt_rules``, then NFKC, which leaves the full-width tilde alone, then
    folding of single characters; ``nfkc_cf`` folds fully (ß becomes ss). Spark has no built-in NFKC, but only texts with characters it may
    change go to Python; ``none`` and ``whitespace`` need none.
    """
    if mode == "none":
        return text
    if mode == "whitespace":
        return collapse_whitespace(text)
    if mode not in ("nfkc", "nfkc_cf", "nmt_nfkc", "nmt_nfkc_cf"):
        raise ValueError(f"unknown normalisation {mode!r}")
    published, folded = mode.startswith("nmt_"), mode.endswith("_cf")
    ready = nmt_rules(text) if published else text
    fold = ("simple" if published else "full") if folded else ""
    stable = ready.rlike(rf"\A[{STABLE}{'' if fold == 'full' else 'ß'}]*+\z")
    changed = _nfkc(F.when(~stable, ready), fold, FULL_TILDE if published else "")
    return collapse_whitespace(F.when(stable, F.lower(ready) if folded else ready).otherwise(changed))


def metaspace(text: Column) -> Column:
    """Mark the text start and every space; empty text stays empty."""
    return F.when(text == "", text).otherwise(F.concat(F.lit(METASPACE), F.replace(text, F.lit(" "), F.lit(METASPACE))))


def metaspace_words(text: Column) -> Column:
    """Words of collapsed text, each with its leading mark. They concatenate to ``metaspace``."""
    return F.filter(F.split(metaspace(text), f"(?={METASPACE})"), lambda w: w != "")


def script_tokens(text: Column) -> Column:
    """Split metaspaced text where the script changes and around digits; nothing is lost."""
    return F.regexp_extract_all(text, F.lit(SCRIPT_TOKEN), F.lit(0))


def tokens_of(text: Column, mode: str = "whitespace") -> Column:
    """normalise -> metaspace -> script split: the word tokens every vocabulary is built from."""
    return script_tokens(metaspace(normalize(text, mode)))


def unmark(text: Column) -> Column:
    """Turn marks back into spaces and drop the one at the start."""
    return F.regexp_replace(F.replace(text, F.lit(METASPACE), F.lit(" ")), "^ ", "")
