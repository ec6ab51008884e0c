from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lotline.llm.quality import COUNTS, SHARES, common_words, describe, judge, text_statistics
from lotline.session import table

CASES = {
    "prose": [
        "The owner asked for more time, and the inspector left without looking at the boiler. We called again on Monday.",
        "the owner asked for more time and nobody knows who should test the kitchen sink we have called them four times about it",
        "Hace seis días que el ascensor no funciona. La portera dijo que falta un electricista, y por eso no se pudo reparar.",
        "房东说大门已经坏了三天。我们打了两次电话,但是水管工没有回答。",
        "We have asked for these repairs twice now, and no one has come to look at them.\n\n- the lift\n- the roof\n- the sink\n\nPlease send someone who can do it before the winter, since the children were asleep in the cold.",
    ],
    "list": ["- one lamp\n- two mops\n- door closer\n- sash cord", "Home > News > Forms > Maps > Help > Search > About", "1) No heat\n2) a stuck window.\n3) peeling paint\n4) no hot water"],
    "table": ["bin\tapt\tamount\n100\t4A\t3811.79\n200\t2B\t99.10\n300\t1C\t7.00", "| a | b |\n|---|---|\n| 1 | 2 |\n| 3 | 4 |"],
    "junk": ["a899c301 3d 9a35 3fa7 417a0f8b 729abd04 3d ef99dbb6", "<td class=a></td><br class=b>0</br><div>&nbsp;</div>", "#-{{>~#};| >]|!%%<=@@]!!;=]^:,%}; &{_-|<&&]", "rtfdbockfet fvvhphjz qeqjnesq icrmuh icsjm tii", "repair repair repair repair repair repair repair"],
    "blank": [None, "", " \n\t "],
}


def test_kinds(spark, sf):
    words, han = common_words(table(spark, sf, "common_word"))
    rows = [(k, t, "x", 1) for k, ts in CASES.items() for t in ts]
    df = spark.createDataFrame(rows, "want string, text string, other string, n_lines int")
    out = judge(text_statistics(df, "text", words, han).withColumn("i", F.monotonically_increasing_id())).collect()
    assert [(r.want, r.kind) for r in out] == [(r.want, r.want) for r in out]
    assert all(bool(r.reasons) == (r.kind in ("list", "table", "junk")) for r in out)


def test_numbers(spark):
    df = spark.createDataFrame([("It is cold. Is it?\r\n- a lamp\rend",), (None,), ("é" * 100000,)], "text string")
    a, b, c = text_statistics(df, "text", ["is", "it", "a"], ["的"]).collect()
    assert (a.n_lines, a.n_words, a.common_words, a.distinct_common, a.n_tokens_ws) == (3, 8, 5, 3, 9)
    assert a.ended_line_share == pytest.approx(1 / 3)
    assert a.bullet_line_share == pytest.approx(1 / 3)
    assert (b.n_words, b.letter_share) == (0, 0.0)
    assert (c.longest_token, c.letter_share) == (100000, 1.0)


WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")


def plain(text, words, han):
    """The statistics of one text, counted one by one."""
    t = (text or "").replace("\r\n", "\n").replace("\r", "\n").replace("\u2028", "\n")
    tokens, found = t.split(), WORD.findall(t.lower())
    lines = [x for x in t.split("\n") if x.strip()]
    n = max(1, len(lines))
    common = [w for w in found if w in words]
    pipes = [x.count("|") for x in lines]
    mid = sorted(pipes)[len(pipes) // 2] if pipes else 0
    return {
        "n_lines": len(lines), "n_words": len(found), "n_tokens_ws": len(tokens), "longest_token": max(map(len, tokens), default=0), "common_words": len(common), "distinct_common": len(set(common)),
        "han_common": sum(t.count(h) for h in han), "pipe_fields": mid + 1, "pipe_regular": pipes.count(mid) / n if mid else 0.0, "mean_word_length": sum(map(len, found)) / max(1, len(found)),
        "ended_line_share": sum(bool(re.search(r"[.!?…。！？][\"'”’»)\]]*\s*$", x)) for x in lines) / n, "short_line_share": sum(len(x.split()) <= 9 for x in lines) / n,
        "gapped_line_share": sum(bool(re.search(r"\S {2,}\S", x)) for x in lines) / n, "ellipsis_line_share": sum(x.rstrip().endswith(("...", "…")) for x in lines) / n,
        "alphabetic_share": sum(any(unicodedata.category(c)[0] == "L" for c in w) for w in tokens) / max(1, len(tokens)), "distinct_word_share": len(set(found)) / max(1, len(found)), "inline_bullets": len(re.findall(r"(?:^|[\s;|,/])(?:[-*+•·▪◦‣]|\[[ xX✓]?\]|\([0-9]{1,3}\)|[0-9]{1,3}[.)])\s", t)),
        "separators": len(re.findall(r"\s[|>»/•·–—-]\s", t)),
    }


PIECES = ["the", "Don't", "can’t", "'quoted'", "x'", "a.", "b!\"'", "…", "...", "|", "| |", "  ", "\t", "\n", "\r\n", "\r", "\u2028", "\u00a0", "12", "3)", "- ", "•", "é", "字", "的", "电梯。", "x1y", "²", "#", "\x00", "\ufffd", "(", ")", "]'"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.lists(st.sampled_from(PIECES), max_size=25).map("".join), st.lists(st.sampled_from(PIECES), max_size=25).map(" ".join)), max_size=6))
def test_vectors_count_like_plain_python(texts):
    words, han = frozenset(["the", "a", "don't"]), frozenset("的")
    got = dict(zip(COUNTS + SHARES, describe(pa.array(texts, pa.string()), words, han), strict=True))
    for i, t in enumerate(texts):
        for name, value in plain(t, words, han).items():
            assert got[name][i] == pytest.approx(value), (name, t)


def test_long_markup_and_long_common_lists(spark):
    """Markup counts however long it is, and a list of common words may have any length."""
    tag = "<a href='" + "x" * 5000 + "'>"
    body = "{" + "y" * 5000 + "}"
    df = spark.createDataFrame([(tag + " word",), (body + " word",)], "text string")
    assert all(r.tag_share > 0.99 for r in text_statistics(df, "text", ["word"], []).collect())
    words, _ = common_words(spark.range(30_000).selectExpr("concat('w', id) as word"))
    assert len(words) == 30_000


def test_published_rules_are_recorded(spark):
    rows = [("- a lamp\n- two mops",), ("word " * 60 + "and the end.",), (None,)]
    out = judge(text_statistics(spark.createDataFrame(rows, "text string"), "text", ["and", "the"], [])).collect()
    assert set(out[0].published_failures) >= {"gopher_words", "gopher_bullets", "gopher_stop_words", "fineweb_punctuation", "fineweb_short_lines"}
    assert out[1].published_failures == []
    assert out[2].published_failures == []


def test_labelled_sample(spark, sf):
    words, han = common_words(table(spark, sf, "common_word"))
    docs = table(spark, sf, "documents").join(table(spark, sf, "doc_label").withColumnRenamed("kind", "label"), "doc_id").select("doc_id", "text", "label")
    rows = judge(text_statistics(docs, "text", words, han)).collect()
    wrong = [r for r in rows if (r.label == "prose") != (r.kind == "prose")]
    assert len(wrong) <= 0.02 * len(rows)


def test_empty(spark):
    df = spark.createDataFrame([], "text string")
    assert judge(text_statistics(df, "text", [], [])).count() == 0
