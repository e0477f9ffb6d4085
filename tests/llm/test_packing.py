import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallyhouse.llm import packing
from tests.llm.conftest import ROWS

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    "", " ", "  ", "a  b", " a", "a ", "x \n y", "\n\n a\n \nb", "don't  stop's 12 3", "tab\t x \t y",
    "  a   b \x1c c", "<|endoftext|> a <|endoftext|>", "日本 語 \U0001f600 \U0001f600", "a\r\n b", " 's it 's",
    "plain words only, some. And\nmore", "a\xa0 b  c", "end ", "\nstart", "one two  three four",
]


def ids_of(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [2]


def test_encoding_equals_the_tokenizer():
    draw = random.Random(3)
    alphabet = ["a", "the", " ", "  ", "\n", "\t", ".", "'s", "9", "É", "\x1c", "\x85", "　", "语", "<|endoftext|>"]
    texts = TEXTS + ["".join(draw.choices(alphabet, k=draw.randint(0, 30))) for _ in range(500)]
    tokenizer = Tokenizer.from_file(PATH)
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    for _ in range(2):  # the second time all words are known
        encoded = packing.encode([t.encode() for t in texts], PATH)
        assert [np.frombuffer(ids, "<u4").tolist() for ids in encoded] == want


def filled(pieces, capacity):
    """Sequences are gapless from 0 and within the capacity."""
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return sequences


def test_round_trip_of_odd_rows(odd):
    pieces = packing.pack(odd, PATH, capacity=64, with_ids=True).collect()
    filled(pieces, 64)
    whole = defaultdict(list)
    for p in sorted(pieces, key=lambda p: p["start"]):
        ids = np.array(p["ids"], dtype="<u4")
        assert zlib.crc32(ids.tobytes()) == p["ids_crc32"] and len(ids) == p["length"] > 0
        if p["piece"]:
            assert p["length"] == 64
        whole[p["doc_id"]].append((p["piece"], p["start"], p["ids"]))
    for doc_id, text, *_ in ROWS:
        copies = sum(r[0] == doc_id for r in ROWS)
        parts = sorted(whole[doc_id])[::copies]
        assert [i for _, _, ids in parts for i in ids] == ids_of(text)
        assert [p for p, _, _ in parts] == list(range(len(parts)))


def test_empty(nothing):
    assert packing.pack(nothing, PATH).count() == 0


def test_documents_and_cost_bound_a_sequence(spark):
    docs = spark.createDataFrame([(i, "a " * (i % 37)) for i in range(400)], "doc_id long, text string")
    options = {"capacity": 128, "most_docs": 5, "most_cost": 2500}
    for rule in ("norm", "dot"):
        pieces = packing.pack(docs.repartition(3), PATH, rule=rule, **options).collect()
        for parts in filled(pieces, 128).values():
            assert len(parts) <= 5 and sum(n * n for _, n in parts) <= 2500
        assert {p["doc_id"] for p in pieces} == set(range(400))


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_plan_is_best_fit_and_tight(rule):
    draw = random.Random(7)
    for lengths in ({1024: 5}, {600: 3, 424: 3}, {1: 3000}, {}):
        steps = packing.plan(lengths, rule=rule)
        bins = max((s[2] + -(-n // s[3]) for s, n in runs_of(steps, lengths)), default=0)
        assert bins == -(-sum(k * n for k, n in lengths.items()) // 1024)
    lengths = {draw.randint(1, 1024): draw.randint(1, 12) for _ in range(500)}
    bins = max(s[2] + -(-n // s[3]) for s, n in runs_of(packing.plan(lengths, rule=rule), lengths))
    assert bins <= 1.005 * one_by_one(lengths) + 1


def one_by_one(lengths, capacity=1024):
    """Bins that best fit opens, piece after piece."""
    left = []
    for length in sorted(lengths, reverse=True):
        for _ in range(lengths[length]):
            best = min((i for i, x in enumerate(left) if x >= length), key=lambda i: left[i], default=None)
            if best is None:
                left.append(capacity - length)
            else:
                left[best] -= length
    return len(left)


def runs_of(steps, lengths):
    """Each step with the number of pieces it places."""
    steps = steps.tolist()
    for this, after in zip(steps, [*steps[1:], None], strict=False):
        end = after[1] if after and after[0] == this[0] else lengths[this[0]]
        yield this, end - this[1]


def test_a_piece_over_the_capacity_is_refused():
    with pytest.raises(ValueError, match="exceeds"):
        packing.plan({2000: 1})
