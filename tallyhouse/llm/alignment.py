"""Alignment of two tokenizers over the same bytes, word by word.

Every text is tokenised in full by both vocabularies, A (byte-level BPE) over a space and
the text, B (sentencepiece BPE) over the text, which adds that space. Texts are cut into
chunks at single spaces between other characters, where both tokenizers always begin a
token (``_whole`` checks that B's vocabulary allows it), verified by the bytes of the
tokens; so a text's ids, groups and links are those of its chunks in order. A chunk is
tokenised and aligned once and remembered, new ones many at once: offsets where tokens of
both end cut the chunk into groups; the last tokens of a group's two sides end together and
are a link.

How often an (A id, B id) pair is linked in the whole corpus is counted in slices of some
``SLICE`` bytes of text: a slice numbers its pairs, its documents hold these numbers, and
only one row per slice and pair is shuffled, however often a pair occurs. The counts come
back to the slices the same way, where each document sums those of its links.

Defined cases: texts that are null, empty or whose tokens of either side do not spell the
space and the text (U+2581, for one) have no tokens: zeros and no groups. A null id is kept;
repeated rows count and come as often as they are there; very long texts are a slice of
their own; no documents give no rows. Only the id, the text and nothing else of the input
is read, so its other columns may have any name.
"""

from __future__ import annotations

import hashlib
import os
import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyhouse.llm.common import column
from tallyhouse.session import settle

SLICE = 16_000_000  # bytes of text
SLICE_DOCS = 8192
BATCH = 500_000  # bytes of text aligned at once
REMEMBERED = 600_000  # chunks a worker remembers
LONGEST = 128  # bytes of a chunk that is remembered
NUMBERED = 2_000_000  # pairs a worker keeps numbers for from task to task
_BREAK = re.compile(r"(?<=\S) (?=\S)")
# White space in ASCII, and how that beyond it starts.
_BLANKS = [bytes([byte]) for byte in b"\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f"]
_WIDE = [b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80"]
SPACE = "▁"  # fixed value: the space in the pieces of B


@cache
def _a(path: str):
    """Tokenizer, and by id: bytes of the token."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # their strings in a text are plain text
    # Fixed rule of byte-level vocabularies: printable bytes stand for themselves, the others
    # for the characters from U+0100 on.
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte_of = {chr(byte): byte for byte in printable}
    others = [byte for byte in range(256) if byte not in set(printable)]
    byte_of |= {chr(0x100 + i): byte for i, byte in enumerate(others)}
    vocab = tokenizer.get_vocab(with_added_tokens=True)
    spelt = [b""] * (max(vocab.values()) + 1)
    for token, i in vocab.items():
        known = all(char in byte_of for char in token)
        spelt[i] = bytes(byte_of[char] for char in token) if known else token.encode()
    return tokenizer, spelt


@cache
def _b(path: str):
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_file=path)
    spelt = []
    for i in range(pieces.get_piece_size()):
        piece = pieces.id_to_piece(i)
        spelt.append(
            bytes([int(piece[3:5], 16)]) if pieces.is_byte(i) else piece.replace(SPACE, " ").encode()
        )
    return pieces, spelt


@cache
def _whole(path: str) -> bool:
    """Whether chunks of B may be tokenised apart: no piece goes on over a space."""
    pieces, _ = _b(path)
    every = (pieces.id_to_piece(i) for i in range(pieces.get_piece_size()))
    return all(SPACE not in piece.lstrip(SPACE) for piece in every)


class Chunks:
    """Ids of chunks (in UTF-8), each as it is after a space, by both tokenizers."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.a_spelt = _a(a_path)
        self.b, self.b_spelt = _b(b_path)
        self.apart = _whole(b_path)
        self.begins_a = np.array([token[:1] == b" " for token in self.a_spelt])
        self.begins_b = np.array([token[:1] == b" " for token in self.b_spelt])

    def split(self, text: bytes) -> list[bytes]:
        if not self.apart:
            return [text]
        chunks = text.split(b" ")
        beside = b"" in chunks or any(
            blank in text and (blank + b" " in text or b" " + blank in text) for blank in _BLANKS
        )
        if not beside and not any(blank in text for blank in _WIDE):
            return chunks
        return [chunk.encode() for chunk in _BREAK.split(text.decode("utf-8", "replace"))]

    def learn(self, chunks: list[bytes]) -> dict[bytes, tuple[bytes, bytes] | None]:
        """Chunks without a space or U+2581 many at once: their ids are cut where a token
        begins with a space. The others one by one."""
        words, others, found = [], [], {}
        for chunk in chunks:
            (words if self.plain(chunk) else others).append(chunk)
        for begin in range(0, len(words), 2000):
            some = words[begin : begin + 2000]
            text = b" ".join(some).decode()
            by_a = self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids
            by_b = self.b.encode([text], num_threads=1)[0]
            found |= zip(some, zip(
                self.cut(by_a, self.begins_a, self.a_spelt, some),
                self.cut(by_b, self.begins_b, self.b_spelt, some),
                strict=True,
            ), strict=True)
        for chunk in others:
            text = chunk.decode("utf-8", "replace")
            by_a = self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids
            by_b = self.b.encode([text], num_threads=1)[0]
            found[chunk] = (
                self.right(by_a, self.a_spelt, b" " + chunk), self.right(by_b, self.b_spelt, b" " + chunk)
            )
        return {chunk: ids if None not in ids else None for chunk, ids in found.items()}

    @staticmethod
    def plain(chunk: bytes) -> bool:
        try:
            text = chunk.decode()
        except UnicodeDecodeError:
            return False
        return bool(text) and " " not in text and text == text.strip() and SPACE not in text

    @staticmethod
    def right(ids: list[int], spelt: list[bytes], text: bytes) -> bytes | None:
        """The packed ids if they spell the text."""
        if b"".join([spelt[i] for i in ids]) != text:
            return None
        return np.array(ids, "<u4").tobytes()

    def cut(self, ids: list[int], begins: np.ndarray, spelt: list[bytes], words: list[bytes]) -> list:
        packed = np.array(ids, "<u4")
        starts = np.flatnonzero(begins[packed]).tolist()
        whole = b"".join([spelt[i] for i in ids])
        if whole == b" " + b" ".join(words) and len(starts) == len(words):
            raw = packed.tobytes()
            return [raw[4 * i : 4 * j] for i, j in zip(starts, [*starts[1:], len(ids)], strict=True)]
        # Some word is not spelt by its tokens: each for itself.
        if len(words) == 1:
            return [None]
        half = len(words) // 2
        return [
            part
            for some in (words[:half], words[half:])
            for part in self.cut(self.ids(some, spelt), begins, spelt, some)
        ]

    def ids(self, words: list[bytes], spelt: list[bytes]) -> list[int]:
        text = b" ".join(words).decode()
        if spelt is self.b_spelt:
            return self.b.encode([text], num_threads=1)[0]
        return self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids


Aligned = tuple[bytes, bytes, int]  # groups with ; after each, pair numbers, sizes


class Aligner:
    """Alignments by chunk; links are pairs of ids, numbered as met."""

    def __init__(self, chunks: Chunks):
        self.chunks = chunks
        self.length_a, self.length_b = (
            np.array([len(token) for token in spelt], dtype=np.int64)
            for spelt in (chunks.a_spelt, chunks.b_spelt)
        )
        # Decimal ids with a place for what follows; zeros are left out.
        named = [str(i).encode() for i in range(max(len(self.length_a), len(self.length_b)))]
        width = len(named[-1]) + 1
        self.named = np.array(named, f"S{width}").view(np.uint8).reshape(-1, width)
        self.known: dict[bytes, Aligned | None] = {}
        self.unspelt: set[bytes] = set()  # those of them that have no alignment
        self.missed = 0
        self.pairs: dict[int, int] = {}

    def forget(self) -> None:
        self.known.clear()
        self.unspelt.clear()
        self.missed = 0

    def learn(self, ids: list[tuple[bytes, bytes]]) -> list[Aligned]:
        """Chunks as one sequence: the tokens of both sides end together where a chunk ends."""
        raw_a, raw_b = zip(*ids, strict=True)
        a, b = np.frombuffer(b"".join(raw_a), "<u4"), np.frombuffer(b"".join(raw_b), "<u4")
        ends_a, ends_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        shared_a = np.isin(ends_a, ends_b, assume_unique=True, kind="table")
        shared_b = np.isin(ends_b, ends_a, assume_unique=True, kind="table")
        last_a, last_b = np.flatnonzero(shared_a), np.flatnonzero(shared_b)
        pairs, place = np.unique(a[last_a].astype(np.int64) << 32 | b[last_b], return_inverse=True)
        numbers = [self.pairs.setdefault(pair, len(self.pairs)) for pair in pairs.tolist()]
        links = np.array(numbers, "<i4")[place].tobytes()

        # A group's A ids, then its B ids.
        count_a, count_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
        at_a = np.arange(len(a)) + np.repeat(last_b + 1 - count_b, count_a)
        at_b = np.arange(len(b)) + np.repeat(last_a + 1, count_b)
        tokens = np.empty(len(a) + len(b), "<u4")
        tokens[at_a], tokens[at_b] = a, b
        written = self.named[tokens]
        written[:, -1] = ord(",")
        written[at_a[last_a], -1] = ord("|")
        written[at_b[last_b], -1] = ord(";")
        filled = written != 0
        text = written[filled].tobytes()

        sizes_a = np.array(list(map(len, raw_a)), dtype=np.int64) // 4
        sizes_b = np.array(list(map(len, raw_b)), dtype=np.int64) // 4
        end_a, end_b = np.cumsum(sizes_a), np.cumsum(sizes_b)
        text_ends = np.cumsum(filled.sum(axis=1))[end_a + end_b - 1].tolist()
        link_ends = (4 * np.cumsum(shared_a)[end_a - 1]).tolist()
        return list(zip(
            [text[i:j] for i, j in zip([0, *text_ends], text_ends)],
            [links[i:j] for i, j in zip([0, *link_ends], link_ends)],
            (sizes_a << 32 | sizes_b).tolist(),
            strict=True,
        ))

    def align(self, texts: list[bytes]) -> list[tuple[bytes, np.ndarray, int, int] | None]:
        """Groups of each text, the numbers of the pairs it links and how many tokens it has;
        None where a side does not spell it."""
        cut = [self.chunks.split(text) if text else [] for text in texts]
        every = set().union(*cut)
        learnt = self.chunks.learn(list(every.difference(self.known)))
        spelt = {chunk: ids for chunk, ids in learnt.items() if ids}
        self.known.update(dict.fromkeys(learnt))
        self.unspelt.update(learnt.keys() - spelt)
        if spelt:
            self.known.update(zip(spelt, self.learn(list(spelt.values())), strict=True))
        known, unspelt = self.known.__getitem__, every & self.unspelt
        out = []
        for chunks in cut:
            if not chunks or unspelt and not unspelt.isdisjoint(chunks):
                out.append(None)
                continue
            groups, numbers, sizes = zip(*map(known, chunks), strict=True)
            n_a, n_b = divmod(sum(sizes), 1 << 32)
            out.append((b"".join(groups)[:-1], np.frombuffer(b"".join(numbers), "<i4"), n_a, n_b))
        self.keep(list(learnt))
        return out

    def keep(self, learnt: list[bytes]) -> None:
        """When full, it takes no more, so what came early and is therefore frequent stays;
        it starts anew when much has been missed since. Very long chunks are not kept."""
        room = max(0, REMEMBERED + len(learnt) - len(self.known))
        self.missed += len(learnt[room:])
        dropped = learnt[room:] + [chunk for chunk in learnt[:room] if len(chunk) > LONGEST]
        for chunk in dropped:
            del self.known[chunk]
        self.unspelt.difference_update(dropped)
        if self.missed > 16 * REMEMBERED:
            self.forget()


@cache
def _aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(Chunks(a_path, b_path))


class Slice:
    """Documents that share one numbering of pairs."""

    def __init__(self, name: int, aligner: Aligner, digest: bool):
        self.name, self.pairs, self.digest = name, aligner.pairs, digest
        self.rows: list[tuple] = []
        self.links: list[np.ndarray] = []
        self.size = 0

    def add(self, doc_id, text: bytes, aligned: tuple[bytes, np.ndarray, int, int] | None) -> None:
        groups, numbers, n_a, n_b = aligned or (b"", np.zeros(0, dtype="<i4"), 0, 0)
        told = hashlib.sha256(groups).hexdigest() if self.digest and groups else groups.decode()
        self.rows.append((doc_id, n_a, n_b, len(numbers), len(numbers), told))
        self.links.append(numbers)
        self.size += len(text)

    def full(self) -> bool:
        return self.size >= SLICE or len(self.rows) >= SLICE_DOCS

    def frame(self) -> pd.DataFrame:
        """A row per document with the slice's numbers of its pairs and how often it links
        each, and before them a row with the slice's pairs and their totals."""
        names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups"]
        out = pd.DataFrame([(None, 0, 0, 0, 0, ""), *self.rows], columns=names)
        out["doc_id"] = out["doc_id"].astype("Int64")
        totals = np.bincount(np.concatenate(self.links), minlength=len(self.pairs))
        used = np.flatnonzero(totals)
        every = np.fromiter(self.pairs, dtype=np.int64, count=len(self.pairs))
        number = np.cumsum(totals > 0) - 1
        held = [zlib.compress(every[used].astype("<i8").tobytes() + totals[used].astype("<i8").tobytes(), 1)]
        for links in self.links:
            which, times = np.unique(number[links], return_counts=True)
            held.append(zlib.compress(which.astype("<i4").tobytes() + times.astype("<i4").tobytes(), 1))
        out["held"] = held
        out["slice"] = self.name
        out["whole"] = [True] + [False] * len(self.rows)
        return out


def _halves(held: bytes, kind: str) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(zlib.decompress(held), kind)
    return both[: len(both) // 2], both[len(both) // 2 :]


def align(
    docs: DataFrame,
    a_path: str,
    b_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: bool = False,
) -> DataFrame:
    """One row per document: ``doc_id n_a n_b n_groups n_links groups n_best count_sum``.

    ``groups`` is the text ``a1,a2|b1;a3|b2,b3``, with ``digest`` its sha256 in hex (an empty
    text stays one). ``count_sum`` adds up, over the document's links, how often the corpus
    links their pair; ``n_best`` are the links whose pair is the most frequent of its B id.
    """

    def sliced(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        aligner = _aligner(a_path, b_path)
        if len(aligner.pairs) > NUMBERED:  # else what earlier tasks learnt goes on
            aligner.forget()
            aligner.pairs.clear()
        task, made = TaskContext.get().partitionId(), 0
        one = Slice(task << 32, aligner, digest)
        for frame in frames:
            texts, begin = list(frame["text"]), 0
            while begin < len(texts):
                end, size = begin, 0
                while end < len(texts) and (end == begin or size + len(texts[end]) <= BATCH):
                    size += len(texts[end])
                    end += 1
                some = texts[begin:end]
                for doc_id, text, aligned in zip(
                    frame["doc_id"].iloc[begin:end], some, aligner.align(some), strict=True
                ):
                    one.add(doc_id, text, aligned)
                    if one.full():
                        yield one.frame()
                        made += 1
                        one = Slice(task << 32 | made, aligner, digest)
                begin = end
        if one.rows:
            yield one.frame()

    narrow = docs.select(
        column(docs, id_col).cast("long").alias("doc_id"),
        F.coalesce(column(docs, text_col), F.lit("")).cast("binary").alias("text"),
    )
    counted = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string"
    stored = settle(narrow.mapInPandas(sliced, f"{counted}, held binary, slice long, whole boolean"))

    def listed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, held in zip(frame["slice"], frame["held"], strict=True):
                pairs, totals = _halves(held, "<i8")
                numbers = np.arange(len(pairs), dtype=np.int32)
                yield pd.DataFrame({"slice": name, "number": numbers, "pair": pairs, "n": totals})

    pairs = stored.where("whole").select("slice", "held")
    pairs = pairs.mapInPandas(listed, "slice long, number int, pair long, n long")
    totals = pairs.groupBy("pair").agg(F.sum("n").alias("total"))
    highest = F.max("total").over(W.partitionBy(F.col("pair").bitwiseAND(0xFFFFFFFF)))
    totals = totals.withColumn("best", F.col("total") == highest)
    known = pairs.join(totals, "pair").select("slice", "number", "total", "best")

    def summed(rows: pd.DataFrame, numbers: pd.DataFrame) -> pd.DataFrame:
        size = len(numbers)
        total, best = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
        total[numbers["number"]] = numbers["total"]
        best[numbers["number"]] = numbers["best"]
        n_best, count_sum = [], []
        for held in rows.pop("held"):
            which, times = _halves(held, "<i4")
            n_best.append(int(best[which] @ times))
            count_sum.append(int(total[which] @ times.astype(np.int64)))
        return rows.drop(columns="slice").assign(n_best=n_best, count_sum=count_sum)

    rows = stored.where("not whole").drop("whole")
    both = rows.groupBy("slice").cogroup(known.groupBy("slice"))
    return both.applyInPandas(summed, f"{counted}, n_best long, count_sum long")
