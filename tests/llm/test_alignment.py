import hashlib
from collections import Counter

import public_tokenizers
import pytest

from tallyhouse.llm import alignment
from tests.llm.conftest import ROWS

PATHS = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum"]
STRANGE = [
    "two  spaces and   three",
    " begins with one",
    "\n\tbegins with others, ends with some \n",
    "no break thin 　 wide",
    "a ▁ sign that stands for the space",
    "▁",
    "<|endoftext|> is <s> plain </s> text <unk> <0x0A>",
    "\x00 zero \x1c control \x85 next",
    "emoji 👩‍👩‍👧 family, tone 👍🏽, math 𝒳",
    "combining é and ​ nothing",
    "don't we'll I'M it's 'quoted'",
    "日本語の文 章です。",
    " ",
    "   ",
    "\n",
    "x" * 3000,
    "same same same same",
]


def brute(rows):
    """Whole texts through both tokenizers, every pair of ends compared."""
    a_tokens, a_spelt = alignment._a(PATHS[0])
    b_tokens, b_spelt = alignment._b(PATHS[1])
    found, counts = [], Counter()
    for doc_id, text in rows:
        a = a_tokens.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_tokens.encode(text) if text else []
        whole = (" " + text).encode() if text else b""
        if b"".join(a_spelt[i] for i in a) != whole or b"".join(b_spelt[i] for i in b) != whole:
            a, b = [], []
        ends_a, ends_b = {}, {}
        for ends, ids, spelt in ((ends_a, a, a_spelt), (ends_b, b, b_spelt)):
            at = 0
            for i, token in enumerate(ids):
                at += len(spelt[token])
                ends[at] = i
        groups, links, i, j = [], [], 0, 0
        for end in sorted(ends_a.keys() & ends_b.keys()):
            to_a, to_b = ends_a[end] + 1, ends_b[end] + 1
            groups.append(",".join(map(str, a[i:to_a])) + "|" + ",".join(map(str, b[j:to_b])))
            links.append((a[to_a - 1], b[to_b - 1]))
            i, j = to_a, to_b
        counts.update(links)
        found.append((doc_id, len(a), len(b), ";".join(groups), links))
    highest = Counter()
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    return sorted(
        (
            (
                doc_id, n_a, n_b, len(links), len(links), groups,
                sum(counts[link] == highest[link[1]] for link in links),
                sum(counts[link] for link in links),
            )
            for doc_id, n_a, n_b, groups, links in found
        ),
        key=str,
    )


def rows_of(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def test_equals_brute_force(spark, odd):
    assert rows_of(alignment.align(odd, *PATHS)) == brute([(r[0], r[1]) for r in ROWS])


def test_strange_texts(spark):
    rows = list(enumerate(STRANGE))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got, want = rows_of(alignment.align(docs, *PATHS)), brute(rows)
    assert got == want
    assert [r for r in got if r[0] in (4, 5)] == [(4, 0, 0, 0, 0, "", 0, 0), (5, 0, 0, 0, 0, "", 0, 0)]


@pytest.mark.parametrize("size,remembered", [(1, 300_000), (2_000, 5), (16_000_000, 0)])
def test_slices_and_memory_change_nothing(spark, monkeypatch, size, remembered):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(60)
    monkeypatch.setattr(alignment, "SLICE", size)
    monkeypatch.setattr(alignment, "REMEMBERED", remembered)
    rows = [(r[0], r[1]) for r in docs.collect()]
    assert rows_of(alignment.align(spark.createDataFrame(rows, docs.schema), *PATHS)) == brute(rows)


def test_unspelt_words_fail_alone():
    chunks = alignment.Chunks(*PATHS)
    a_tokens, _ = alignment._a(PATHS[0])
    words = [b"one", b"two", b"three"]
    spelt = list(chunks.a_spelt)
    for i in a_tokens.encode(" two", add_special_tokens=False).ids:
        spelt[i] = b" tw0"
    ids = a_tokens.encode(" one two three", add_special_tokens=False).ids
    parts = chunks.cut(ids, chunks.begins_a, spelt, words)
    assert parts[1] is None and None not in (parts[0], parts[2])


def test_digest_and_empty(spark, odd, nothing):
    text = rows_of(alignment.align(odd, *PATHS))
    digest = rows_of(alignment.align(odd, *PATHS, digest=True))
    told = [(*r[:5], hashlib.sha256(r[5].encode()).hexdigest() if r[5] else "", *r[6:]) for r in text]
    assert sorted(told, key=str) == digest
    assert alignment.align(nothing, *PATHS).count() == 0
    assert alignment.align(odd, *PATHS).columns == COLUMNS[:6] + COLUMNS[6:]


def test_chunks_learnt_together_equal_brute_force(monkeypatch):
    """All new chunks of a batch are aligned in one call; what is not remembered changes nothing."""
    words = [f"{chr(97 + i % 26) * (i % 5 + 1)}{i * 7919 % 10007:x},ndé{i}" for i in range(6000)]
    texts = [" ".join(words[i : i + 300]) for i in range(0, len(words), 300)]
    texts += [*STRANGE, "", "one ▁ two", texts[3], "\n" + texts[4] + " \n x"]
    want = brute(list(enumerate(texts)))
    for remembered, longest in ((1_000_000, 128), (100, 128), (0, 0)):
        monkeypatch.setattr(alignment, "REMEMBERED", remembered)
        monkeypatch.setattr(alignment, "LONGEST", longest)
        aligner = alignment.Aligner(alignment.Chunks(*PATHS))
        learn, calls = aligner.learn, []
        monkeypatch.setattr(aligner, "learn", lambda ids, at=learn: calls.append(len(ids)) or at(ids))
        half = len(texts) // 2
        found = aligner.align([text.encode() for text in texts[:half]])
        found += aligner.align([text.encode() for text in texts[half:]])
        assert len(calls) == 2 and sum(calls) >= len(words)
        assert all(len(chunk) <= longest for chunk in aligner.known)
        assert min(remembered, 1) <= len(aligner.known) <= remembered
        pairs, counts, highest = list(aligner.pairs), Counter(), Counter()
        linked = [[pairs[i] for i in one[1]] if one else [] for one in found]
        for links in linked:
            counts.update(links)
        for pair, n in counts.items():
            highest[pair & 0xFFFFFFFF] = max(highest[pair & 0xFFFFFFFF], n)
        got = [
            (
                i, *(one[2:] if one else (0, 0)), len(links), len(links), one[0].decode() if one else "",
                sum(counts[pair] == highest[pair & 0xFFFFFFFF] for pair in links),
                sum(counts[pair] for pair in links),
            )
            for i, (one, links) in enumerate(zip(found, linked, strict=True))
        ]
        assert sorted(got, key=str) == want
