"""One query per operator over the whole documents table, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.llm import (bpe, centroids, filter_audit, fingerprints, language, licenses, mixing, near_dups, ngram_lm, packing, secret_scan,
                          token_files, weak_rules)
from zonecast.llm.common import crc_mod, documents
from zonecast.session import shared_folder, stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


@query
def op1_byte_bpe(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    done = bpe.round_trip(F.col("text"), path, public_tokenizers.PATTERN)
    return documents(spark, sf_dir).select("doc_id", done.alias("done")).select("doc_id", "done.*")


@query
def op4_secrets(spark, sf_dir):
    scanned = documents(spark, sf_dir).select("doc_id", secret_scan.spans_of(F.col("text")).alias("found"))
    found = F.col("found")
    counts = [F.size(secret_scan.of_kinds(found, kind)).cast("long").alias(f"n_{kind}") for kind in secret_scan.BASE]
    base = secret_scan.of_kinds(found, *secret_scan.BASE)
    return scanned.select("doc_id", *counts, F.sha2(secret_scan.listed(base), 256).alias("base_sha256"),
                          secret_scan.listed(found).alias("spans"))


@query
def op6_mixing(spark, sf_dir):
    return mixing.mixture(documents(spark, sf_dir))


@query
def op9_near_dups(spark, sf_dir):
    return near_dups.near_duplicates(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id", "kept")


@query
def op10_language(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    held_out = F.coalesce(crc_mod(F.col("doc_id"), 4) == 2, F.lit(False))
    trees = language.train(docs.filter(crc_mod(F.col("doc_id"), 4) != 2))
    said = language.language_of(spark, trees, F.col("text"))
    return docs.select("doc_id", held_out.alias("held_out"), said.alias("said")).select("doc_id", "held_out", "said.*")


# The same word counts, keys, parts and rounds; sources are joined null-safe.
_MIX_ROUND = """
fits{n} AS (SELECT *, NOT taken AND size <= gap AS fits FROM rows{n}),
sums{n} AS (SELECT *, sum(CASE WHEN fits THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY es_key, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto FROM fits{n}),
rows{next} AS (
  SELECT * EXCLUDE (fits, upto, taken, gap), taken OR (fits AND upto <= gap) AS taken,
         gap - coalesce(max(CASE WHEN fits AND upto <= gap THEN upto END) OVER (PARTITION BY source), 0) AS gap FROM sums{n}),"""
ORACLES["op6_mixing"] = r"""
WITH docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         -ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':20'), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE)
         / coalesce(greatest(0.1::DOUBLE, 1.0::DOUBLE - (length(text) - length(translate(text, '0123456789#*$%&|<>{}[]()=+_~^@\/', '')))::DOUBLE / nullif(length(text), 0)), 0.1::DOUBLE) AS es_key
  FROM documents),
sources AS (
  SELECT source, ceil(count(*) / 4096.0)::BIGINT AS parts, sum(size)::BIGINT AS source_size, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM docs GROUP BY source),
levels AS (SELECT *, 3 * source_size AS "limit", 3 * source_size / weight::DOUBLE AS level FROM sources),
reached AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum("limit") OVER b, 0))::DOUBLE / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS reached
  FROM levels WINDOW b AS (ORDER BY level, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
common AS (SELECT first(reached ORDER BY level, source NULLS LAST) AS common FROM reached WHERE reached < level),
goals AS (
  SELECT source, parts, source_size, CASE WHEN reached >= level THEN "limit"::DOUBLE ELSE common * weight END AS target
  FROM reached LEFT JOIN common ON TRUE),
goal AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs,
         target - CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT * source_size AS rest FROM goals),
placed AS (
  SELECT d.*, g.source_size, g.target, g.epochs, g.rest, g.parts, least(parts - 1, floor((1.0::DOUBLE - exp(-es_key)) * parts)::BIGINT) AS part
  FROM docs d JOIN goal g ON d.source IS NOT DISTINCT FROM g.source),
part_sums AS (SELECT source, part, sum(size)::BIGINT AS words FROM placed GROUP BY source, part),
ends AS (SELECT *, sum(words) OVER (PARTITION BY source ORDER BY part) AS part_end FROM part_sums),
stops AS (
  SELECT e.source, min(e.part) AS stop, first(e.part_end - e.words ORDER BY e.part) AS before
  FROM ends e JOIN goal g ON e.source IS NOT DISTINCT FROM g.source WHERE part_end > rest GROUP BY e.source),
rows0 AS (
  SELECT p.*, coalesce(stop, parts) AS stop, rest - coalesce(before, 0) AS gap, FALSE AS taken
  FROM placed p LEFT JOIN stops s ON p.source IS NOT DISTINCT FROM s.source WHERE part = coalesce(stop, parts)),""" + "".join(
    _MIX_ROUND.format(n=n, next=n + 1) for n in range(4)) + """
fillers AS (SELECT *, NOT taken AND abs(gap - size) < gap AS may FROM rows4),
chosen AS (
  SELECT source, es_key, doc_id, size, taken OR (may AND row_number() OVER (PARTITION BY source, may ORDER BY abs(gap - size), es_key, doc_id, size) = 1) AS inside
  FROM fillers),
decided AS (
  SELECT p.*, p.part < coalesce(s.stop, parts) OR coalesce(c.inside, FALSE) AS partial
  FROM placed p LEFT JOIN stops s ON p.source IS NOT DISTINCT FROM s.source
  LEFT JOIN chosen c ON p.source IS NOT DISTINCT FROM c.source AND p.doc_id = c.doc_id)
SELECT doc_id, size, source_size, target, CASE WHEN size > 0 THEN (epochs + partial::BIGINT) * size ELSE 0 END::BIGINT AS taken
FROM decided
"""


@query
def op2_token_files(spark, sf_dir):
    folder = shared_folder(spark, "token-files")
    token_files.write_shards(documents(spark, sf_dir), folder, public_tokenizers.path("word_bpe_49k.json"), added_tokens=True)
    return token_files.read_shards(spark, folder, ids=False)


@query
def op3_order_minhash(spark, sf_dir):
    return fingerprints.edited_neighbours(documents(spark, sf_dir).select("doc_id", "text"))


@query
def op7_licenses(spark, sf_dir):
    found = licenses.scan(documents(spark, sf_dir).select("doc_id", "text"))
    base = F.col("base")
    return found.select("doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(base).cast("long").alias("first_word"),
                        F.array_max(base).cast("long").alias("last_word"), F.array_join("base_labels", ",").alias("base_labels"),
                        F.array_join("labels", ",").alias("labels"), "score")


@query
def op8_weak_supervision(spark, sf_dir):
    rows = documents(spark, sf_dir).select("doc_id", weak_rules.measured(F.col("text")).alias("m")).select("doc_id", "m.*")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (weak_rules.judged(stored(rows, "measures")).withColumn("base_failed", failed)
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                    (~F.col("base_failed") & F.col("good")).alias("kept"), "quality"))


@query
def op5_lm(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    scored = ngram_lm.scores(docs, crc_mod(F.col("doc_id"), 7) != 2)
    held_out = F.coalesce(crc_mod(F.col("doc_id"), 7) == 2, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op11_centroids(spark, sf_dir):
    return centroids.clustered(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query
def op12_packing(spark, sf_dir):
    return packing.packed(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


@query
def op13_filter_audit(spark, sf_dir):
    return filter_audit.audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


# Plain Lloyd rounds: every vector against every centroid.
_CLUSTER_ROUND = """
near{n} AS MATERIALIZED (
  SELECT rid, min(struct_pack(d := d, c := c)) AS best
  FROM (SELECT rid, c, sum((x - y) * (x - y))::BIGINT AS d FROM vec JOIN cent{n} USING (i) GROUP BY rid, c) GROUP BY rid),"""
_CLUSTER_MOVE = """
cent{next} AS MATERIALIZED (
  SELECT o.c, o.i, coalesce(m.y, o.y) AS y FROM cent{n} o LEFT JOIN (
    SELECT best.c AS c, i, CASE WHEN sum(x) >= 0 THEN sum(x) // count(*) ELSE -((-sum(x) + count(*) - 1) // count(*)) END::BIGINT AS y
    FROM near{n} JOIN vec USING (rid) GROUP BY best.c, i) m USING (c, i)),"""
ORACLES["op11_centroids"] = """
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, [floor(256 * x::DOUBLE)::BIGINT for x in embedding] AS v FROM embeddings
  WHERE len(embedding) = 64 AND len([x for x in embedding if x IS NOT NULL AND isfinite(x)]) = 64),
vec AS MATERIALIZED (SELECT rid, unnest(range(64)) AS i, unnest(v) AS x FROM kept),
first AS (SELECT v, row_number() OVER (ORDER BY vec_id IS NULL, sha256('2:' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS c FROM kept),
cent0 AS MATERIALIZED (SELECT c, unnest(range(64)) AS i, unnest(v) AS y FROM first WHERE c < 40),""" + "".join(
    _CLUSTER_ROUND.format(n=n) + _CLUSTER_MOVE.format(n=n, next=n + 1) for n in range(5)) + _CLUSTER_ROUND.format(n=5) + """
sums AS (SELECT best.c AS c, sum(best.d)::BIGINT AS cluster_inertia FROM near5 GROUP BY best.c),
said AS (SELECT c, sha256(string_agg(y::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM cent5 GROUP BY c)
SELECT vec_id, best.c::INTEGER AS cluster, best.d AS distance, cluster_inertia, (SELECT sum(cluster_inertia) FROM sums)::BIGINT AS inertia, centroid_sha256
FROM near5 JOIN kept USING (rid) JOIN sums ON sums.c = best.c JOIN said ON said.c = best.c
"""

# Every document goes through every order step by step.
ORACLES["op13_filter_audit"] = r"""
WITH letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS o FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
docs AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least FROM documents),
told AS (SELECT doc_id, bool_or(coalesce(quality = 1, FALSE)) AS good, bool_or(coalesce(toxic = 1, FALSE)) AS toxic FROM labels GROUP BY doc_id),
failing AS MATERIALIZED (
  SELECT part, coalesce(good, FALSE) AS good, coalesce(told.toxic, FALSE) AS toxic,
         CASE WHEN len(words) < 100 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 'B' ELSE '' END
         || CASE WHEN 100 * len(regexp_extract_all(text, '[A-Z]')) > 10 * length(text) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN coalesce(docs.doc_id > least, FALSE) THEN 'E' ELSE '' END AS fails
  FROM docs LEFT JOIN told USING (doc_id)),
steps AS (SELECT o, s::INTEGER AS step, o[s] AS f, o[1:s - 1] AS before FROM orders, (SELECT unnest(range(1, 6)) AS s)),
kinds AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM failing GROUP BY part, fails),
seen AS (
  SELECT part, o, step, f, n, good, toxic, contains(fails, f) AS fail, fails = f AS single, len(translate(before, fails, '')) < len(before) AS gone
  FROM kinds, steps),
counted AS (
  SELECT part, o AS filter_order, step, f, coalesce(sum(n) FILTER (NOT gone AND NOT fail), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (NOT gone AND fail), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (gone AND fail), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (single), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (NOT gone AND fail), 0)::BIGINT AS good_lost, coalesce(sum(toxic) FILTER (NOT gone AND fail), 0)::BIGINT AS toxic_lost
  FROM seen GROUP BY part, o, step, f)
SELECT * EXCLUDE (f), sum(removed) OVER (PARTITION BY part, f)::BIGINT AS shapley FROM counted
"""
