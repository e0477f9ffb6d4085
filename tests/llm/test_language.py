from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import language
from tests.llm.conftest import ROWS


def counted(text):
    out = Counter()
    word = ""
    for char in [*(text or "").lower(), " "]:
        if char.isalpha():
            word += char
        elif word:
            padded = f" {word} "
            out.update(word)
            out.update(padded[i : i + 2] for i in range(len(padded) - 1))
            out.update(padded[i : i + 3] for i in range(len(padded) - 2))
            word = ""
    return out


def number(gram):
    """The order of n-grams with equal counts."""
    code = [0 if c == " " else ord(c) for c in gram]
    if len(code) == 1:
        return -code[0]
    if len(code) == 2:
        return code[0] << 42 | code[1]
    return code[0] << 42 | code[1] << 21 | code[2]


def ranked(counts, top):
    return [number(g) for g in sorted(counts, key=lambda g: (-counts[g], number(g)))[:top]]


def brute(rows, learn, top):
    totals = {}
    for _, text, lang in learn:
        if lang is not None and text is not None:
            totals.setdefault(lang, Counter()).update(counted(text))
    profiles = {lang: {g: i for i, g in enumerate(ranked(c, top))} for lang, c in totals.items() if c}
    out = []
    for doc_id, text, _ in rows:
        mine = ranked(counted(text), top)
        if not mine or not profiles:
            out.append((doc_id, "und", 0.0))
            continue
        apart = {
            lang: sum(abs(i - p[g]) if g in p else top for i, g in enumerate(mine))
            for lang, p in profiles.items()
        }
        best = min(sorted(apart), key=apart.get)
        out.append((doc_id, best, 1 - apart[best] / (top * len(mine))))
    return out


@pytest.mark.parametrize("top", [300, 20])
def test_equals_brute_force(odd, top):
    got = language.identify(odd, language.profiles(odd, top=top), top=top, extra=["doc_id"]).collect()
    rows = [r[:3] for r in ROWS]
    want = brute(rows, rows, top)
    assert sorted([(r[0], r[1], round(r[2], 12)) for r in got], key=str) == sorted(
        [(d, lang, round(s, 12)) for d, lang, s in want], key=str
    )


def test_slices_and_flushes_change_nothing(odd, monkeypatch):
    whole = sorted(map(str, language.profiles(odd).collect()))
    monkeypatch.setattr(language, "SLICE", 7)
    monkeypatch.setattr(language, "HELD", 50)
    texts = [r[1] for r in ROWS if r[1]]
    sizes = [end - begin for begin, end in language.sliced(texts)]
    assert sum(sizes) == len(texts) and min(sizes) >= 1
    assert sorted(map(str, language.profiles(odd).collect())) == whole


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    held = F.pmod("doc_id", F.lit(3)) == 1
    got = language.identify(docs, language.profiles(docs.where(~held)), extra=["doc_id", "lang"])
    right = got.where(held).agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right >= 0.98


def test_empty(odd, nothing):
    assert language.profiles(nothing).count() == 0
    assert language.identify(nothing, language.profiles(odd)).count() == 0
    every = language.identify(odd, language.profiles(odd), extra=odd.columns)
    assert every.columns == [*odd.columns, "lang_pred", "score_"] and every.count() == len(ROWS)
    told = language.identify(odd, language.profiles(nothing), extra=["doc_id"]).collect()
    assert {(r["lang_pred"], r["score"]) for r in told} == {("und", 0.0)}
