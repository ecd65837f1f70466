"""Registered queries of the training-data operators, each over its whole table."""
from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bitplane_kmeans, bpe, collocations, decontaminate, kd_sharding, language_id, line_dedup, near_dedup, piece_bpe, token_output, toxicity, vamana, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    """A vocabulary file; ``TOKENIZER_DIR`` names another folder than the installed one."""
    folder = os.environ.get("TOKENIZER_DIR")
    return os.path.join(folder, name) if folder else public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, d, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op2_vamana(spark: SparkSession, d: str) -> DataFrame:
    return vamana.nearest(table(spark, d, "embeddings"), F.col("id") % 20 == 0, 20)


def op3_near_dedup(spark: SparkSession, d: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, d, "documents"), shingle=3, similarity=(85, 100))


def op4_token_output(spark: SparkSession, d: str) -> DataFrame:
    return token_output.token_store_digest(table(spark, d, "documents"), tokenizer("byte_bpe_50k.json"))


def op5_bpe(spark: SparkSession, d: str) -> DataFrame:
    out = bpe.encode_decode(table(spark, d, "documents").select("doc_id", "text"), tokenizer("word_bpe_49k.json"))
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op6_warc(spark: SparkSession, d: str) -> DataFrame:
    return warc.warc_round_trip(table(spark, d, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_toxicity(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, d, "labels"), toxicity.fold(F.col("id"), 5) != 0)
    out = toxicity.score(docs, model)
    return out.select("doc_id", F.coalesce(toxicity.fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_language_id(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text", "lang")
    model = language_id.train(docs, toxicity.fold(F.col("id"), 4) != 2)
    out = language_id.predict(docs.select("doc_id", "text"), model)
    return out.select("doc_id", F.coalesce(toxicity.fold(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op9_kd_sharding(spark: SparkSession, d: str) -> DataFrame:
    return kd_sharding.shard_by_bytes(table(spark, d, "documents"), 16)


def op10_decontaminate(spark: SparkSession, d: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, d, "documents"), table(spark, d, "benchmark"))


def op11_collocations(spark: SparkSession, d: str) -> DataFrame:
    return collocations.collocations(table(spark, d, "documents"), least=30, top=2000)


def op12_sentencepiece(spark: SparkSession, d: str) -> DataFrame:
    out = piece_bpe.encode_decode(table(spark, d, "documents").select("doc_id", "text"), tokenizer("piece_bpe_32k.model"))
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op13_bitplane_kmeans(spark: SparkSession, d: str) -> DataFrame:
    return bitplane_kmeans.cluster_vectors(table(spark, d, "embeddings"), k=8, rounds=10, seed=3, scale=1024)


def pipeline(spark: SparkSession, d: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, d)


QUERIES = {f.__name__: f for f in (op1_line_dedup, op2_vamana, op3_near_dedup, op4_token_output, op5_bpe, op6_warc, op7_toxicity, op8_language_id,
                                   op9_kd_sharding, op10_decontaminate, op11_collocations, op12_sentencepiece, op13_bitplane_kmeans,
                                   pipeline)}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"



def _lloyd_rounds(k: int, rounds: int, seed: int) -> str:
    """DuckDB: components as rows, a table of centroids and one of assignments for each round."""
    ctes = [f"""v AS MATERIALIZED (SELECT vec_id, unnest(range(1, 65)) AS j, unnest(list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT))) AS x
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS MATERIALIZED (SELECT c, j, x AS y FROM v JOIN (SELECT vec_id, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS c FROM (SELECT DISTINCT vec_id FROM v)) USING (vec_id) WHERE c < {k})"""]
    for r in range(rounds + 1):
        ctes.append(f"""d{r} AS (SELECT vec_id, c, CAST(sum((x - y) * (x - y)) AS BIGINT) AS distance FROM v JOIN c{r} USING (j) GROUP BY ALL),
a{r} AS MATERIALIZED (SELECT vec_id, arg_min(c, (distance, c)) AS c, min(distance) AS distance FROM d{r} GROUP BY vec_id)""")
        if r < rounds:
            ctes.append(f"""s{r} AS (SELECT c, j, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM v JOIN a{r} USING (vec_id) GROUP BY c, j),
c{r + 1} AS MATERIALIZED (SELECT c, j, coalesce((s - ((s % n) + n) % n) // n, y) AS y FROM c{r} LEFT JOIN s{r} USING (c, j))""")
    return "WITH " + ",\n".join(ctes) + f"""
SELECT vec_id, CAST(c AS INTEGER) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{rounds} JOIN (SELECT c, sha256(string_agg(y, ',' ORDER BY j)) AS centroid_sha256 FROM c{rounds} GROUP BY c) USING (c)"""


ORACLES = {
    "op11_collocations": f"""WITH pieces AS (SELECT coalesce(lang, 'und') AS lang,
  unnest(string_split(translate(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), ',;:!?' || chr(10) || chr(11) || chr(12) || chr(13) || chr(9), '......... '), '.')) AS piece FROM documents),
w AS MATERIALIZED (SELECT lang, list_filter(string_split(piece, ' '), lambda x: x <> '') AS w FROM pieces),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
f AS MATERIALIZED ({" UNION ALL ".join(f"""SELECT lang, phrase, {s} AS size, count(*) AS f FROM (
  SELECT lang, unnest(list_transform(range(1, len(w) - {s - 2}), lambda i: array_to_string(w[i:i + {s - 1}], ' '))) AS phrase FROM w WHERE len(w) >= {s})
  GROUP BY lang, phrase HAVING count(*) >= 30""" for s in (1, 2, 3, 4))}),
c AS (SELECT lang, phrase, size, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size >= 2),
held AS (SELECT lang, array_to_string(w[i:i + s - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(range(1, size - s + 2)) AS i FROM (SELECT *, unnest(range(2, size)) AS s FROM c)) GROUP BY ALL),
cut AS (SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS p, array_to_string(w[k + 1:], ' ') AS q FROM (SELECT *, unnest(range(1, size)) AS k FROM c)),
best AS (SELECT cut.lang, cut.phrase, a, x.f AS l, y.f AS r, CAST((CAST(2000000 AS HUGEINT) * a) // (x.f + y.f) AS BIGINT) AS score
  FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = p JOIN f y ON y.lang = cut.lang AND y.phrase = q
  QUALIFY row_number() OVER (PARTITION BY cut.lang, cut.phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM best LEFT JOIN held USING (lang, phrase) JOIN total USING (lang)
WHERE longer IS NULL OR CAST(100 AS HUGEINT) * longer < CAST(80 AS HUGEINT) * a
QUALIFY rank <= 2000""",
    "op13_bitplane_kmeans": _lloyd_rounds(8, 10, 3),
    "op1_line_dedup": f"""WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(range(1, len(lines) + 1)) AS pos, unnest(lines) AS line FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UPPER}', '{_LOWER}') AS key FROM l),
o AS (SELECT key, min(doc_id) AS owner FROM k WHERE length(key) >= 10 GROUP BY key),
m AS (SELECT k.*, (o.owner IS NOT NULL AND o.owner <> k.doc_id) AS dropped FROM k LEFT JOIN o USING (key))
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (WHERE dropped) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM m GROUP BY doc_id""",
    "op6_warc": """WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
q AS (SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha256(body) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first FROM q WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first < page_id THEN first END AS refers_to
FROM q LEFT JOIN f USING (payload_digest)""",
}
