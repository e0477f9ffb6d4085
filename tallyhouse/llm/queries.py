"""The registered queries of this package, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import (
    alignment,
    language,
    lattice,
    lexical,
    licenses,
    linededup,
    minhash,
    mixing,
    neighbours,
    packing,
    quality,
    secrets,
    toxicity,
)
from tallyhouse.llm.common import documents, remainder, table

Query = Callable[[SparkSession, str], DataFrame]


def held_out(docs: DataFrame, modulus: int, kept_back: int) -> Column:
    """Whether a document is in the fold that nothing is learnt from; a null id is not."""
    return F.coalesce(remainder(docs["doc_id"], modulus) == kept_back, F.lit(False))


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "source")
    return mixing.mix(docs, keep=["doc_id"]).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(documents(spark, sf_dir), path)


def op3_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_duplicates(table(spark, sf_dir, "embeddings"))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    docs = docs.withColumn("held_out", held_out(docs, 4, 2))
    return toxicity.score(
        docs, docs.where(~docs["held_out"]), table(spark, sf_dir, "labels"), extra=["doc_id", "held_out"]
    )


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", held_out(docs, 3, 1))
    learnt = language.profiles(docs.where(~docs["held_out"]))
    return language.identify(docs, learnt, extra=["doc_id", "held_out"])


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.search(vectors, vectors["vec_id"] % 20 == 0)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    docs = docs.withColumn("held_out", held_out(docs, 3, 1))
    weights = quality.fit(docs.where(~docs["held_out"]), table(spark, sf_dir, "labels"))
    return quality.score(docs, weights, extra=["doc_id", "held_out"])


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.line_report(documents(spark, sf_dir))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    aligned = alignment.align(documents(spark, sf_dir), a, b, digest=True)
    return aligned.withColumnRenamed("groups", "groups_sha256")


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = documents(spark, sf_dir).select("doc_id", "text")
    scanned = secrets.scan(docs, path, public_tokenizers.PATTERN)

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s.kind != "random")
    return scanned.select(
        "doc_id",
        *[count(kind) for kind in secrets.KINDS],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


QUERIES: dict[str, Query] = {
    "op1_mixing": op1_mixing,
    "op2_packing": op2_packing,
    "op3_lattice": op3_lattice,
    "op4_minhash": op4_minhash,
    "op5_toxicity": op5_toxicity,
    "op6_language": op6_language,
    "op7_neighbours": op7_neighbours,
    "op8_quality": op8_quality,
    "op9_licenses": op9_licenses,
    "op10_line_dedup": op10_line_dedup,
    "op11_alignment": op11_alignment,
    "op12_search": op12_search,
    "op13_secrets": op13_secrets,
}

OP1_SQL = f"""
WITH sized AS (
  SELECT doc_id, source,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighted AS (
  SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM sources
), ordered AS (
  SELECT *,
    (sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER before, 0))::DOUBLE AS remaining,
    (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::BIGINT AS open_weight
  FROM weighted
  WINDOW before AS (
    ORDER BY 3.0::DOUBLE * source_size / weight, source NULLS LAST
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING
  )
), stopped AS (
  SELECT *, 3.0::DOUBLE * source_size * open_weight < weight * remaining AS over FROM ordered
), level AS (
  SELECT max_by(remaining / open_weight, open_weight) AS level FROM stopped WHERE NOT over
), targets AS (
  SELECT source, source_size,
    CASE WHEN over THEN 3.0::DOUBLE * source_size ELSE weight * level END AS target
  FROM stopped, level
), placed AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
    row_number() OVER (
      PARTITION BY d.source
      ORDER BY class, part, d.size, d.doc_id NULLS LAST
    )::DOUBLE AS place,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate
  FROM (
    SELECT *,
      length(bin(size)) * 4 + CASE WHEN length(bin(size)) < 3 THEN size % 4
        ELSE (size >> (length(bin(size)) - 3)::INT) - 4 END AS class,
      ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 4))::INT % {mixing.HASHED} AS part
    FROM sized
  ) d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  ((floor({mixing.offset()!r}::DOUBLE + place * rate)
    - floor({mixing.offset()!r}::DOUBLE + (place - 1) * rate))::BIGINT * size)::BIGINT AS taken
FROM placed
"""

OP10_SQL = f"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), lines AS (
  SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos, len(ls) AS n_lines FROM split
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), firsts AS (
  SELECT key, min(doc_id) AS first_id FROM keyed WHERE length(key) >= {linededup.LEAST} GROUP BY key
), marked AS (
  SELECT k.*, coalesce(f.first_id < k.doc_id, FALSE) AS gone
  FROM keyed k LEFT JOIN firsts f ON k.key = f.key
)
SELECT doc_id, max(n_lines)::BIGINT AS n_lines,
  (count(*) FILTER (WHERE gone))::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

# Components of a relation links(a, b): every id with the ids it reaches.
REACHED = """
ends AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reached AS (
  SELECT a AS id, b AS other FROM ends
  UNION
  SELECT r.id, e.b FROM reached r JOIN ends e ON r.other = e.a
)
"""

OP3_SQL = f"""
WITH RECURSIVE wide AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
), usable AS (
  SELECT * FROM wide WHERE len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(v, lambda x: x <> 0)) > 0
), links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y
  ON x.vec_id < y.vec_id AND list_cosine_similarity(x.v, y.v) >= {lattice.LEAST}
), {REACHED}, counted AS (
  SELECT a AS id, count(*) AS n FROM ends GROUP BY a
)
SELECT vec_id, n_links, component_id, vec_id = component_id AS kept FROM (
  SELECT w.vec_id, coalesce(any_value(c.n), 0)::BIGINT AS n_links,
    least(w.vec_id, min(r.other)) AS component_id
  FROM wide w LEFT JOIN reached r ON r.id = w.vec_id LEFT JOIN counted c ON c.id = w.vec_id
  GROUP BY w.vec_id
)
"""

OP4_SQL = f"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws
  FROM documents
), sets AS (
  SELECT doc_id, list_distinct(
    CASE WHEN len(ws) = 0 THEN []::VARCHAR[]
      WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
      ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END
  ) AS items
  FROM worded
), flat AS (
  SELECT doc_id, len(items) AS n, unnest(items) AS item FROM sets
), shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, x.n AS na, y.n AS nb, count(*) AS common
  FROM flat x JOIN flat y ON x.item = y.item AND x.doc_id < y.doc_id
  GROUP BY ALL
), links AS (
  SELECT a, b FROM shared WHERE 100 * common >= 75 * (na + nb - common)
), {REACHED}
SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM (
  SELECT s.doc_id, any_value(len(s.items))::BIGINT AS n_shingles,
    least(s.doc_id, min(r.other)) AS component_id
  FROM sets s LEFT JOIN reached r ON r.id = s.doc_id GROUP BY s.doc_id
)
"""

OP12_SQL = """
WITH numbered AS (
  SELECT row_number() OVER () AS row, doc_id, text FROM documents
), terms AS (
  SELECT row, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM numbered
), counted AS (
  SELECT row, any_value(doc_id) AS doc_id, term, count(*) AS tf FROM terms GROUP BY row, term
), sizes AS (
  SELECT row, sum(tf)::BIGINT AS n FROM counted GROUP BY row
), corpus AS (
  SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS words FROM sizes
), norms AS (
  SELECT row, 50 + (50 * n * docs) // words AS m FROM sizes, corpus
), weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM counted, corpus GROUP BY term, docs
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM benchmark
), scored AS (
  SELECT item_id, row, any_value(doc_id) AS doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN counted USING (term) JOIN norms USING (row)
  GROUP BY item_id, row
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, row_number() OVER (
    PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST
  ) AS rank
  FROM scored WHERE score > 0
) WHERE rank <= 50
"""

ORACLES: dict[str, str] = {
    "op1_mixing": OP1_SQL,
    "op3_lattice": OP3_SQL,
    "op4_minhash": OP4_SQL,
    "op10_line_dedup": OP10_SQL,
    "op12_search": OP12_SQL,
}
