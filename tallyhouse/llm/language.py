"""Language of a text by rank-order profiles of character n-grams.

N-grams have one to three characters of a word in lower case with a blank at either end. A
language's profile is its ``TOP`` most frequent n-grams over all documents that may be
learnt from, ranked (equal counts by code points). A document is ranked alike and compared
with each profile: the out-of-place distance sums, over its n-grams, how far the ranks lie
apart, or ``TOP`` for n-grams that a profile lacks. The nearest language is the prediction,
ties go to the smaller name; the score is one minus the distance over the largest possible.

Profiles are counted per task and summed by (language, n-gram); what the driver sees is
``TOP`` rows per language. Texts are scored where they are read, with no shuffle.

Defined cases: a null text or one without a letter is ``und`` with score 0, and so are all
without anything learnt; a document whose language is null teaches nothing, a null id is
not held out; repeated rows count as often as they come; no documents give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyhouse.llm.common import column, named

TOP = 300
UNKNOWN = "und"
SLICE = 1_000_000  # characters that are counted at once
HELD = 2_000_000  # counts a task holds before it hands them on


@cache
def _letters() -> np.ndarray:
    """By code point: itself for letters, 0 for all else."""
    every = np.arange(0x110000, dtype=np.int64)
    return np.where([chr(i).isalpha() for i in range(0x110000)], every, 0)


def sliced(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Row spans of about ``SLICE`` characters, at least one row each."""
    begin, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > SLICE:
            yield begin, i
            begin, size = i, 0
        size += len(text)
    if begin < len(texts):
        yield begin, len(texts)


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams of the texts as numbers, and the text each comes from.

    A number holds 21 bits per character, a blank being 0, so it stands for one n-gram.
    """
    lowered = [text.lower() for text in texts]
    data = "\n".join(["", *lowered, ""]).encode("utf-32-le", "surrogatepass")
    code = _letters()[np.frombuffer(data, dtype=np.uint32)]
    owner = np.repeat(np.arange(len(texts)), [len(text) + 1 for text in lowered])
    owner = np.concatenate([[0], owner])
    one = np.flatnonzero(code)  # the middle of an n-gram of three is a letter
    two = np.flatnonzero((code[:-1] != 0) | (code[1:] != 0))
    number = np.concatenate(
        [
            -code[one],
            code[two] << 42 | code[two + 1],  # nothing in the middle
            code[one - 1] << 42 | code[one] << 21 | code[one + 1],
        ]
    )
    return number, np.concatenate([owner[one], owner[two + 1], owner[one]])


def ranked(numbers: np.ndarray, counts: np.ndarray, top: int) -> np.ndarray:
    """The ``top`` most frequent n-grams, equal counts by number."""
    if len(counts) > 4 * top:
        least = np.partition(counts, len(counts) - top)[len(counts) - top]
        some = counts >= least
        numbers, counts = numbers[some], counts[some]
    return numbers[np.lexsort((numbers, -counts))[:top]]


def profiles(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", top: int = TOP
) -> DataFrame:
    """``lang rank gram`` of each language's ``top`` n-grams, ranks from 0."""

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for frame in frames:
            for lang, texts in frame.groupby("lang")["text"]:
                texts = list(texts)
                for begin, end in sliced(texts):
                    found, n = np.unique(grams(texts[begin:end])[0], return_counts=True)
                    held.append(pd.DataFrame({"lang": lang, "gram": found, "n": n}))
                    size += len(found)
                    if size > HELD:
                        summed = pd.concat(held).groupby(["lang", "gram"], as_index=False)["n"].sum()
                        held, size = [summed], len(summed)
                        if size > HELD // 2:
                            yield summed
                            held, size = [], 0
        if held:
            yield pd.concat(held).groupby(["lang", "gram"], as_index=False)["n"].sum()

    taught = docs.select(
        column(docs, lang_col).cast("string").alias("lang"), column(docs, text_col).alias("text")
    ).where("lang is not null and text is not null")
    counts = taught.mapInPandas(counted, "lang string, gram long, n long")
    totals = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    best = totals.withColumn("rank", place).where(F.col("rank") <= top)
    return best.select("lang", (F.col("rank") - 1).alias("rank"), "gram")


def identify(
    docs: DataFrame,
    learnt: DataFrame,
    text_col: str = "text",
    top: int = TOP,
    extra: list[str] | None = None,
) -> DataFrame:
    """Columns ``extra`` of each row (all but the text by default), ``lang_pred``, ``score``.

    ``learnt`` comes from ``profiles``; it has ``top`` rows per language.
    """
    rows = learnt.collect()
    names = sorted({r["lang"] for r in rows})
    known = np.array(sorted({r["gram"] for r in rows}), dtype=np.int64)
    ranks = np.full((len(known), len(names)), -1, dtype=np.int32)
    for r in rows:
        ranks[np.searchsorted(known, r["gram"]), names.index(r["lang"])] = r["rank"]
    model = docs.sparkSession.sparkContext.broadcast((names, known, ranks))

    def nearest(document: np.ndarray) -> tuple[str, float]:
        names, known, ranks = model.value
        if not len(document) or not names:
            return UNKNOWN, 0.0
        at = np.minimum(np.searchsorted(known, document), len(known) - 1)
        theirs = np.where((known[at] == document)[:, None], ranks[at], -1)
        apart = np.abs(np.arange(len(document))[:, None] - theirs)
        distance = np.where(theirs < 0, top, apart).sum(axis=0)
        best = int(distance.argmin())
        return names[best], 1 - float(distance[best]) / (top * len(document))

    def judged(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = list(frame["text"])
            found = []
            for begin, end in sliced(texts):
                number, owner = grams(texts[begin:end])
                codes, values = pd.factorize(number)
                order = np.argsort(owner, kind="stable")
                cuts = np.searchsorted(owner[order], np.arange(end - begin + 1))
                codes = codes[order]
                for i in range(end - begin):
                    counts = np.bincount(codes[cuts[i] : cuts[i + 1]])
                    some = np.flatnonzero(counts)
                    found.append(nearest(ranked(values[some], counts[some], top)))
            out = frame.drop(columns="text")
            yield out.assign(lang_pred=[x for x, _ in found], score=[x for _, x in found])

    extra = [c for c in docs.columns if c != text_col] if extra is None else extra
    texted = docs.select(
        *[column(docs, name).alias(f"c{i}") for i, name in enumerate(extra)],
        F.coalesce(column(docs, text_col), F.lit("")).alias("text"),
    )
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in texted.schema[:-1])
    out = texted.mapInPandas(judged, f"{types}, lang_pred string, score double")
    return named(out, docs, extra)
