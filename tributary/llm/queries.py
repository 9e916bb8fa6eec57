"""The corpus operators as registered queries over the driver tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm import (bpe, chosen_path, collocations, decontaminate, fingerprints, mixing, pii, ring, runs,
                           secret_scan, substrings, templates)
from tributary.llm import toxicity as tox
from tributary.llm.common import prepare, table


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(table(prepare(spark), sf_dir, "documents"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = chosen_path.jaccard_classes(table(prepare(spark), sf_dir, "documents"))
    return classes.select("doc_id", "class_id", "n_links")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ring.shard_documents(table(prepare(spark), sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return tox.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(prepare(spark), sf_dir, "documents"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(table(prepare(spark), sf_dir, "documents"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.extract_main_text(table(prepare(spark), sf_dir, "pages"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(prepare(spark), sf_dir, "documents"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup_substrings(table(prepare(spark), sf_dir, "documents")).drop("removed")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digest(runs.find_runs(runs.with_periods(table(prepare(spark), sf_dir, "documents"))))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(prepare(spark), sf_dir, "documents"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    decoded = bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN), ranks)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                          F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {f.__name__: f for f in (op1_fingerprints, op2_jaccard_join, op3_sharding, op4_toxicity, op5_decontamination, op6_personal_data,
                                  op7_secrets, op8_html_extraction, op9_mixing, op10_substring_dedup,
                                  op11_periodic_runs, op12_collocations, op13_byte_bpe)}
# The others learn, hash, or match patterns with code point offsets; tests/llm has what each is compared with: brute force,
# the tiktoken library, or held-out accuracy.
ORACLE: dict[str, str] = {
    "op2_jaccard_join": r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(lower(coalesce(text, '')), '[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT rid, sh FROM (
    SELECT rid, unnest(CASE WHEN len(ws) >= 5
                            THEN list_transform(generate_series(1, len(ws) - 4), lambda k: array_to_string(ws[k:k + 4], ' '))
                            WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS sh
    FROM d)),
z AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
p AS (SELECT a.rid AS a, b.rid AS b, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.rid <> b.rid GROUP BY 1, 2),
l AS (
  SELECT p.a, p.b FROM p JOIN z x ON x.rid = p.a JOIN z y ON y.rid = p.b
  WHERE p.c >= 0.8 * (x.n + y.n - p.c) - 1e-9),
r AS (SELECT rid AS a, rid AS b FROM d UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
cls AS (SELECT r.a AS rid, min(d.doc_id) AS class_id FROM r JOIN d ON d.rid = r.b GROUP BY r.a),
n AS (SELECT a AS rid, count(*) AS n_links FROM l GROUP BY a)
SELECT d.doc_id, cls.class_id, CAST(coalesce(n.n_links, 0) AS BIGINT) AS n_links
FROM d JOIN cls USING (rid) LEFT JOIN n USING (rid)
""",
    "op12_collocations": r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
n AS (SELECT lang, sum(len(ws)) AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, unnest(list_transform(generate_series(1, len(ws) - k + 1), lambda i: ws[i:i + k - 1])) AS g
      FROM w, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(ws) >= k),
f AS (SELECT lang, k, g, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 100),
gone AS (
  SELECT DISTINCT lang, s AS g FROM (
    SELECT lang, a, k, unnest([g[1:k - 1], g[2:k]]) AS s FROM f WHERE k > 2) x
  JOIN (SELECT lang, g AS s, a AS b FROM f) y USING (lang, s) WHERE x.a >= y.b),
c AS (SELECT * FROM f ANTI JOIN gone USING (lang, g) WHERE k > 1),
cuts AS (
  SELECT c.lang, c.g, c.a, j, l.a AS l, r.a AS r, n.n,
         (1000::HUGEINT * c.a * n.n) // (l.a::HUGEINT * r.a) AS score
  FROM (SELECT *, unnest(generate_series(1, k - 1)) AS j FROM c) c
  JOIN f l ON l.lang = c.lang AND l.g = c.g[1:j] JOIN f r ON r.lang = c.lang AND r.g = c.g[j + 1:c.k]
  JOIN n ON n.lang = c.lang),
least AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, j) = 1),
ranked AS (
  SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, n, score,
         row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(array_to_string(g, ' '))) AS rank
  FROM least)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l,
       CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= 2000
""",
    "op10_substring_dedup": r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
runs AS (SELECT rid, k, ws[k:k + 34] AS run FROM (SELECT rid, ws, unnest(generate_series(1, len(ws) - 34)) AS k FROM d)),
again AS (SELECT run FROM runs GROUP BY run HAVING count(*) > 1),
gone AS (
  SELECT DISTINCT rid, k + i AS pos
  FROM (SELECT rid, k, unnest(generate_series(0, 34)) AS i FROM runs SEMI JOIN again USING (run))),
words AS (SELECT rid, unnest(ws) AS w, unnest(generate_series(1, len(ws))) AS pos FROM d),
kept AS (SELECT rid, string_agg(w, ' ' ORDER BY pos) AS t FROM words ANTI JOIN gone USING (rid, pos) GROUP BY rid),
n AS (SELECT rid, count(*) AS n FROM gone GROUP BY rid)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid) LEFT JOIN n USING (rid)
""",
}
