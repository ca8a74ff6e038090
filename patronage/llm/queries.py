"""The registered queries of this subpackage and their SQL.

A query applies its operator with production parameters to the whole table and
returns the digest columns of its contract.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronage.llm import (
    alignment,
    bpe,
    collocations,
    fingerprints,
    language,
    packing,
    quality,
    sharding,
    simhash_dedup,
    suffix_dedup,
    token_counts,
    token_files,
    topk,
)
from patronage.llm.common import checkpointed, remove_path, scratch_path, table


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash of all documents and of their edited texts."""
    return fingerprints.digest(fingerprints.fingerprint_documents(table(spark, sf_dir, "documents")))


def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents whose fingerprints differ in 3 bits at most."""
    found = simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), words=3, max_bits=3)
    return simhash_dedup.digest(found)


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents by backtracking BPE, and what they decode to."""
    return bpe.digest(bpe.encode_decode(table(spark, sf_dir, "documents")))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Harmonic packing of all documents into sequences of 1024 tokens."""
    return packing.digest(packing.pack(table(spark, sf_dir, "documents"), capacity=1024, end_id=0))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Karmarkar-Karp byte balance of all documents over 40 shards."""
    return sharding.digest(sharding.shard(table(spark, sf_dir, "documents"), 40))


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest integer inner products of every 20th vector."""
    vectors = topk.integer_vectors(table(spark, sf_dir, "embeddings"), scale=64.0)
    return topk.top_k(vectors, F.col("vec_id") % 20 == 0, 20)


OP6_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
    FROM v q JOIN v c ON c.vec_id <> q.vec_id
    WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored)
WHERE r <= 20
"""


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts by source, language and tokenizer version after a load, the
    removal of equal texts and a new version for one language."""
    return token_counts.corpus_history(table(spark, sf_dir, "documents"))


OP7_SQL = r"""
WITH d AS (
    SELECT doc_id, lang, source, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id NULLS LAST) AS copy
    FROM documents),
counted AS (
    SELECT source, lang, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
           len(regexp_extract_all(text, '[.,;:!?]')) AS stops
    FROM d WHERE copy = 1)
SELECT source, lang, CASE WHEN lang = 'en' THEN 'words-2' ELSE 'words-1' END AS tokenizer,
       count(*) AS documents, CAST(sum(words + CASE WHEN lang = 'en' THEN stops ELSE 0 END) AS BIGINT) AS tokens
FROM counted GROUP BY ALL
"""


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What goes of each document when strings of 400 bytes that start twice go."""
    return suffix_dedup.measure(table(spark, sf_dir, "documents"), 400)


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written to seekable token files and read back."""
    folder = scratch_path(spark, "tokens")
    manifest = token_files.write(table(spark, sf_dir, "documents"), folder, end_id=2)
    rows = token_files.placed(token_files.digest(token_files.read(spark, folder)), manifest)
    out = checkpointed(rows.select("doc_id", "start", "n_tokens", "ids_crc32"))
    remove_path(spark, folder)
    return out


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents by a Bradley-Terry model of their labels."""
    docs = table(spark, sf_dir, "documents")
    return quality.digest(quality.scores(docs, quality.train(docs, table(spark, sf_dir, "labels"))))


def op11_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents by a bidirectional recurrent network over bytes."""
    docs = table(spark, sf_dir, "documents")
    return language.digest(language.predict(docs, language.train(docs)))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two tokenizers aligned by their ends, links valued by corpus counts."""
    return alignment.digest(alignment.align(table(spark, sf_dir, "documents"), detail=False))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 collocations of each language."""
    return collocations.mine(table(spark, sf_dir, "documents"), top=2000)


OP13_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS piece, words FROM (
        SELECT lang, list_filter(regexp_split_to_array(p, '[ \t]'), lambda w: w <> '') AS words FROM (
            SELECT lang, unnest(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\r\x0B\x0C]')) AS p
            FROM documents))
    WHERE len(words) > 0),
w AS (
    SELECT lang, piece, unnest(words) AS w1, generate_subscripts(words, 1) AS i FROM pieces),
o AS (
    SELECT lang, w1, lead(w1) OVER p AS w2, lead(w1, 2) OVER p AS w3 FROM w WINDOW p AS (PARTITION BY piece ORDER BY i)),
f1 AS (SELECT lang, w1, count(*) AS f FROM o GROUP BY ALL),
f2 AS (SELECT lang, w1, w2, count(*) AS f FROM o WHERE w2 IS NOT NULL GROUP BY ALL),
f3 AS (SELECT lang, w1, w2, w3, count(*) AS f FROM o WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
n AS (SELECT lang, sum(f) AS n FROM f1 GROUP BY lang),
cuts AS (
    SELECT c.lang, c.w1 || ' ' || c.w2 AS phrase, c.f AS a, x.f AS l, y.f AS r, 1 AS k,
           c.f >= 10 AND NOT EXISTS (SELECT 1 FROM f3 t WHERE t.lang = c.lang AND 100 * t.f >= 50 * c.f
                                     AND t.w1 = c.w1 AND t.w2 = c.w2)
           AND NOT EXISTS (SELECT 1 FROM f3 t WHERE t.lang = c.lang AND 100 * t.f >= 50 * c.f
                           AND t.w2 = c.w1 AND t.w3 = c.w2) AS kept
    FROM f2 c JOIN f1 x ON x.lang = c.lang AND x.w1 = c.w1 JOIN f1 y ON y.lang = c.lang AND y.w1 = c.w2
    WHERE c.f >= 10
    UNION ALL
    SELECT c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, c.f, x.f, y.f, 1, true
    FROM f3 c JOIN f1 x ON x.lang = c.lang AND x.w1 = c.w1 JOIN f2 y ON y.lang = c.lang AND y.w1 = c.w2 AND y.w2 = c.w3
    UNION ALL
    SELECT c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, c.f, x.f, y.f, 2, true
    FROM f3 c JOIN f2 x ON x.lang = c.lang AND x.w1 = c.w1 AND x.w2 = c.w2 JOIN f1 y ON y.lang = c.lang AND y.w1 = c.w3),
scored AS (
    SELECT *, CAST(1000000 * CAST(a AS HUGEINT) * a // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score FROM cuts WHERE kept),
lowest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
JOIN n USING (lang)
WHERE rank <= 2000
"""

QUERIES = {
    "op1_fingerprints": op1_fingerprints,
    "op2_simhash_dedup": op2_simhash_dedup,
    "op3_bpe": op3_bpe,
    "op4_packing": op4_packing,
    "op5_sharding": op5_sharding,
    "op6_topk": op6_topk,
    "op7_token_counts": op7_token_counts,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_token_files": op9_token_files,
    "op10_quality": op10_quality,
    "op11_language": op11_language,
    "op12_alignment": op12_alignment,
    "op13_collocations": op13_collocations,
}

ORACLE_SQL: dict[str, str] = {
    "op6_topk": OP6_SQL,
    "op7_token_counts": OP7_SQL,
    "op13_collocations": OP13_SQL,
}
