import random
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from tests.llm.conftest import CLASHING, ROWS, SCHEMA
from tests.llm.test_linededup import brute as brute_lines
from tests.llm.test_minhash import brute as brute_groups
from tests.llm.test_mixing import expected_targets, words
from tests.llm.test_packing import filled, ids_of

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Odd rows, and planted toxic documents, repeated lines and near copies."""
    draw = random.Random(6)
    rows, toxic = [(d, (t or "")[:3000] if t is not None else None, *r) for d, t, *r in ROWS], set()
    for i in range(240):
        text = "\n".join(
            " ".join(f"w{draw.randint(0, 800)}" for _ in range(draw.randint(5, 30))) for _ in range(3)
        )
        if i % 6 == 0:
            text += " " + " ".join(f"vile{draw.randint(0, 5)}" for _ in range(4))
            toxic.add(100 + i)
        if i % 5 == 0:
            text += "\nThis line is found in every fifth document"
        rows.append((100 + i, text, "en", f"s{i % 3}", len(text)))
    for i in (1, 2, 3):
        rows.append((500 + i, rows[len(ROWS) + 10 * i + 1][1] + " extra", "en", "s1", None))
    path = tmp_path_factory.mktemp("corpus")
    df = spark.createDataFrame(rows, SCHEMA)
    from pyspark.sql import functions as F

    df.withColumns({c: F.lit("x") for c in CLASHING}).write.parquet(f"{path}/documents.parquet")
    labels = [(100 + i, int(100 + i in toxic)) for i in range(0, 240, 2)]
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path), rows, toxic


@pytest.fixture(scope="module")
def outputs(spark, folder, tmp_path_factory):
    """What each stage returns, written and read again as the next one's input."""
    out, docs = [], spark.read.parquet(f"{folder[0]}/documents.parquet")
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{tmp_path_factory.mktemp('stage')}/{number}"
        stage(spark, docs, folder[0]).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_stages(outputs):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line dedup", "MinHash near-dedup", "mixing sources", "best-fit packing"
    ]
    for df in outputs[:-1]:
        assert df.columns == COLUMNS


def test_toxic_documents_go(folder, outputs):
    _, rows, toxic = folder
    kept = Counter(r["doc_id"] for r in outputs[0].collect())
    assert not toxic & kept.keys()
    assert kept == Counter(r[0] for r in rows if r[0] not in toxic)


def test_repeated_lines_go(outputs):
    want = [(d, t) for d, _, _, t in brute_lines(pairs(outputs[0]))]
    assert sorted([(d, t or "") for d, t in pairs(outputs[1])], key=str) == sorted(want, key=str)
    assert all(r["n_chars"] == (len(r["text"]) if r["text"] is not None else None) for r in outputs[1].collect())


def test_one_of_each_group_stays(outputs):
    before = pairs(outputs[1])
    stay = {d for d, _, _, kept in brute_groups(before) if kept} | {None}
    # Rows without id have texts of their own here; a repeated row stays once.
    assert sorted(pairs(outputs[2]), key=str) == sorted({p for p in before if p[0] in stay}, key=str)


def test_sources_are_mixed(outputs):
    before, after = outputs[2].collect(), outputs[3].collect()
    sizes, taken, largest = Counter(), Counter(), Counter()
    for r in before:
        sizes[r["source"]] += words(r["text"])
        largest[r["source"]] = max(largest[r["source"]], words(r["text"]))
    for r in after:
        taken[r["source"]] += words(r["text"])
    targets = expected_targets(dict(sizes))
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= largest[s] + 0.05 * targets[s]
    allowed = Counter({p: 3 * n for p, n in Counter(pairs(outputs[2])).items()})
    assert not Counter(pairs(outputs[3])) - allowed


def test_all_is_packed(outputs):
    pieces = outputs[4].collect()
    sequences = filled(pieces, 1024)
    lengths = defaultdict(int)
    for p in pieces:
        lengths[p["doc_id"]] += p["length"]
    want = defaultdict(int)
    for doc_id, text in pairs(outputs[3]):
        want[doc_id] += len(ids_of(text))
    assert lengths == want
    assert len(sequences) <= 1.05 * sum(lengths.values()) / 1024 + 1


def test_run_chains_the_stages(spark, folder, outputs):
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    run = corpus_pipeline.run(spark, folder[0]).select(*columns).collect()
    assert sorted(map(str, run)) == sorted(map(str, outputs[4].select(*columns).collect()))


def test_empty_documents(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet").limit(0)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder[0]}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
