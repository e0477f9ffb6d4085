"""Secrets in texts: known forms, and random strings found by token efficiency.

Three kinds are patterns: ``assign`` (a value given to a password, token or key), ``access``
(access key ids), ``hex`` (long hexadecimal strings). Beyond them, a run of ``LEAST`` or more
letters, digits and ``+/_=-`` is ``random`` if a byte-pair vocabulary needs many tokens for
it: words, even made-up ones, are built from frequent pieces, random strings are not, so at
most ``RATIO`` characters a token give them away. Left out before are known digests (hex in
the lengths of MD5 and the SHA families, also after ``sha256-`` and the like) and
identifiers: numbers, UUIDs, ULIDs, and names made of words, with one number at most, whose
pieces between digits, signs and capitals have four or more letters on average. What a pattern has found already is
not found again.

A span of the patterns covers the whole match, name and quotes of an assignment included;
``start`` and ``end`` count code points, the end is exclusive. Spans come by start, then
``assign``, ``access``, ``hex``, ``random``.

Defined cases: a null or empty text has no spans; a null id and repeated rows stay as they
are; equal starts go by kind; long texts are scanned whole, alone in their block; no
documents give no rows. The columns asked for with ``extra`` may have any name: ``spans``
gets a tail if one of them has its name.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import column, named

KINDS = ["assign", "access", "hex", "random"]
LEAST, RATIO = 20, 1.9
BLOCK = 2_000_000  # bytes of text scanned at once

# --- fixed values: the patterns of the contract, and forms that are no secrets -------------
ASSIGN = re.compile(
    rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I
)
NAMES = [b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key"]
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 6, 20, 24
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
DIGEST_LENGTHS = {32, 40, 56, 64, 96, 128}
DIGEST = re.compile(r"(?:(?:md5|sha1|sha224|sha256|sha384|sha512)[-_=/]+)?([0-9a-fA-F]+)")
INTEGRITY = re.compile(r"sha(?:1|224|256|384|512)[-_=/]+[A-Za-z0-9+/]+={0,2}")
UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
ULID = re.compile(r"[0-7][0-9A-HJKMNP-TV-Z]{25}")
# --- end of fixed values --------------------------------------------------------------------

_HEX = np.zeros(256, dtype=bool)
_HEX[list(b"0123456789abcdef")] = True
_RUN = np.zeros(256, dtype=bool)
_RUN[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-")] = True
_NUMBERS = re.compile(r"[0-9]+")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[A-Z]")


@cache
def vocabulary(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("scan", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def is_known(run: str) -> bool:
    """Whether a run is a digest or an identifier."""
    digest = DIGEST.fullmatch(run)
    if digest and len(digest[1]) in DIGEST_LENGTHS:
        return True
    if INTEGRITY.fullmatch(run) or UUID.fullmatch(run) or ULID.fullmatch(run):
        return True
    letters = sum(map(str.isalpha, run))
    if letters == 0:
        return True
    worded = letters >= 4 * len(_WORDS.findall(run)) and letters >= len(run) / 2
    return worded and len(_NUMBERS.findall(run)) <= 1


def is_random(run: str, tokens, ratio: float) -> bool:
    return not is_known(run) and len(run) <= ratio * len(tokens.encode_ordinary(run))


def runs(marks: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Begins and ends of the longest runs of true marks, ``least`` long at least."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], marks, [False]])))
    begins, ends = edges[::2], edges[1::2]
    some = ends - begins >= least
    return list(zip(begins[some].tolist(), ends[some].tolist(), strict=True))


def found(data: bytes, tokens, least: int, ratio: float) -> list[tuple[int, int, int]]:
    """``(begin, end, kind)`` of the spans, in bytes. No span goes over a line's end."""
    codes = np.frombuffer(data, dtype=np.uint8)
    out = [(begin, end, 2) for begin, end in runs(_HEX[codes], LEAST_HEX)]
    if b"AKIA" in data:
        out += [(*m.span(), 1) for m in ACCESS.finditer(data) if m.end() - m.start() >= LEAST_ACCESS]
    lowered = data.lower()
    if any(name in lowered for name in NAMES):
        out += [(*m.span(), 0) for m in ASSIGN.finditer(data) if m.end(2) - m.start(2) >= LEAST_VALUE]
    covered = np.zeros(len(data) + 1, dtype=np.int32)
    for begin, end, _ in out:
        covered[begin] += 1
        covered[end] -= 1
    covered = np.cumsum(covered) > 0
    for begin, end in runs(_RUN[codes], least):
        if not covered[begin:end].any() and is_random(data[begin:end].decode(), tokens, ratio):
            out.append((begin, end, 3))
    return sorted(out, key=lambda span: (span[0], span[2]))


def in_characters(data: bytes, spans: list[tuple[int, int, int]]) -> list[dict]:
    if not data.isascii():
        codes = np.frombuffer(data, dtype=np.uint8)
        before = np.concatenate([[0], np.cumsum((codes & 0xC0) != 0x80)])
        spans = [(int(before[begin]), int(before[end]), kind) for begin, end, kind in spans]
    return [{"kind": KINDS[kind], "start": begin, "end": end} for begin, end, kind in spans]


def blocks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Row spans of some ``BLOCK`` bytes, at least one row each."""
    begin, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > BLOCK:
            yield begin, i
            begin, size = i, 0
        size += len(text)
    if begin < len(texts):
        yield begin, len(texts)


def scan_texts(texts: list[bytes], tokens, least: int = LEAST, ratio: float = RATIO) -> list[list[dict]]:
    """Spans of each text (in UTF-8); texts are scanned together, a zero byte between them,
    which no pattern holds."""
    out: list[list[dict]] = []
    for begin, end in blocks(texts):
        some = texts[begin:end]
        starts = np.cumsum([0, *[len(text) + 1 for text in some]])
        spans: list[list] = [[] for _ in some]
        for first, last, kind in found(b"\0".join(some), tokens, least, ratio):
            i = int(np.searchsorted(starts, first, side="right")) - 1
            spans[i].append((first - int(starts[i]), last - int(starts[i]), kind))
        out += [in_characters(text, mine) if mine else [] for text, mine in zip(some, spans, strict=True)]
    return out


def scan(
    docs: DataFrame,
    vocabulary_path: str,
    pattern: str,
    text_col: str = "text",
    extra: list[str] | None = None,
    least: int = LEAST,
    ratio: float = RATIO,
) -> DataFrame:
    """Columns ``extra`` of each row (all but the text by default) and its ``spans``.

    ``pattern`` is the regular expression by which the vocabulary cuts texts into words.
    """

    def scanned(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens = vocabulary(vocabulary_path, pattern)
        for frame in frames:
            texts = list(frame.pop("text"))
            yield frame.assign(spans=scan_texts(texts, tokens, least, ratio))

    extra = [c for c in docs.columns if c != text_col] if extra is None else extra
    texted = docs.select(
        *[column(docs, name).alias(f"c{i}") for i, name in enumerate(extra)],
        F.coalesce(column(docs, text_col), F.lit("")).cast("binary").alias("text"),
    )
    kept = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in texted.schema[:-1])
    spans = "array<struct<kind:string,start:int,end:int>>"
    return named(texted.mapInPandas(scanned, f"{kept}spans {spans}"), docs, extra)
