from pathlib import Path

import pytest

from tallyhouse.llm.queries import ORACLES, QUERIES
from tools.check_oracle import connect, differences

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no driver tables")

COLUMNS = {
    "op2_packing": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op5_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op6_language": ["doc_id", "held_out", "lang_pred", "score"],
    "op7_neighbours": ["query_id", "rank", "vec_id", "score"],
    "op8_quality": ["doc_id", "held_out", "score", "predicted"],
    "op9_licenses": ["doc_id", "license", "dice"],
    "op11_alignment": ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"],
    "op13_secrets": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
}


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, connection, name):
    assert differences(spark, connection, name, FOLDER) == []


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_rows(spark, name):
    df = QUERIES[name](spark, FOLDER)
    assert set(COLUMNS[name]) <= set(df.columns)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    if "held_out" in df.columns:
        assert df.count() == docs.count()


def test_every_operator_has_a_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
