"""The registered queries of this package: whole tables, production parameters."""
from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dieflow.llm import (
    alignment, contamination, language, line_runs, near_dup, quality, records, recurrent, repeats, segmentations, token_counts as tokens, topk, trie,
)
from dieflow.llm.common import table
from dieflow.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


@query("op1_benchmark_templates")
def op1_benchmark_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op2_line_runs", """
WITH l AS (
  SELECT doc_id, lines, unnest(lines) AS line, generate_subscripts(lines, 1) AS i
  FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE text <> '')
), c AS (
  SELECT doc_id, lines, line, i, len(regexp_extract_all(line, '\\S+')) AS words,
    sum(len(regexp_extract_all(line, '\\S+'))) OVER (PARTITION BY doc_id ORDER BY i) AS upto FROM l
), w AS (
  SELECT a.doc_id, a.i AS s, min(b.i) AS e FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.i >= a.i AND b.upto - a.upto + a.words >= 20 GROUP BY a.doc_id, a.i
  UNION
  SELECT a.doc_id, max(b.i) AS s, a.i AS e FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.i <= a.i AND a.upto - b.upto + b.words >= 20 GROUP BY a.doc_id, a.i
), n AS (
  SELECT w.doc_id, s, e, row_number() OVER (PARTITION BY array_to_string(lines[s : e], chr(10)) ORDER BY w.doc_id, s) AS copy
  FROM w JOIN (SELECT DISTINCT doc_id, lines FROM l) d ON d.doc_id = w.doc_id
), gone AS (
  SELECT DISTINCT l.doc_id, l.i FROM l JOIN n ON n.doc_id = l.doc_id AND n.copy > 1 AND l.i BETWEEN n.s AND n.e
), kept AS (
  SELECT l.doc_id, count(*) AS n_lines, count(gone.i) AS n_removed, coalesce(string_agg(line, chr(10) ORDER BY l.i) FILTER (WHERE gone.i IS NULL), '') AS text
  FROM l LEFT JOIN gone ON gone.doc_id = l.doc_id AND gone.i = l.i GROUP BY l.doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM documents d LEFT JOIN kept USING (doc_id)""")
def op2_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_runs.dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "line_dedup.n_lines", "line_dedup.n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query("op3_exact_topk", """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256.0 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
)
SELECT * FROM ranked WHERE rank <= 5""")
def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query("op4_quality_classifier")
def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    trusted = table(spark, sf_dir, "labels").filter("quality = 1").filter(~held_out).select("doc_id")
    scored = quality.quality_scores(table(spark, sf_dir, "documents"), trusted, ~held_out)
    return scored.select("doc_id", (~F.col("learned_from")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query("op5_page_language")
def op5_page_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


@query("op6_near_duplicates", """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM w WHERE len(w) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), links AS (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n_both FROM s x JOIN s y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL)
  JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * n_both >= 75 * (na.n + nb.n - n_both)
), reach AS (
  SELECT doc_id, doc_id AS other FROM documents UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other
), c AS (
  SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
)
SELECT c.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, c.doc_id = component_id AS kept FROM c LEFT JOIN n USING (doc_id)""")
def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), similar=75)


@query("op7_token_counts")
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op8_binary_records")
def op8_binary_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "records")
    records.write_records(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"))
    return records.read_records(spark, folder, with_ids=False)


@query("op9_repeated_strings")
def op9_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeated_strings(table(spark, sf_dir, "documents"))


@query("op10_sampled_segmentations")
def op10_sampled_segmentations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both ways: the sampled ids of each text, and the text that decoding them gives."""
    found = segmentations.sampled_segmentations(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), k=2, with_text=True)
    return found.withColumn("ids_crc32", F.crc32("ids"))


@query("op11_recurrent_scores")
def op11_recurrent_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 == 0, F.lit(False))
    return recurrent.recurrent_scores(table(spark, sf_dir, "documents"), ~held_out)


@query("op12_prefix_trie", """
WITH o AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
  FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
  SELECT conv_id, conv_id - conv_id % 100 AS model, xor(4294967295, list_reduce(
    list_concat([4294967295::BIGINT], flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda x: [ord(x)::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0]))),
    lambda x, y: CASE WHEN y > 0 THEN xor(x, y) ELSE xor(x >> 1, 3988292384 * (x & 1)) END)) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM o)
), t AS (
  SELECT ids.conv_id, i, role, text FROM ids JOIN o ON o.conv_id = model AND i <= h
  UNION ALL SELECT conv_id, i, role, text FROM ids JOIN o USING (conv_id) WHERE i > h
), s AS (
  SELECT conv_id, list(sha256(concat(length(role), ':', role, text)) ORDER BY i) AS k, list(length(text) ORDER BY i) AS chars FROM t GROUP BY conv_id
), m AS (
  SELECT conv_id, d, coalesce(k[1 : d], []) AS k, coalesce(CASE WHEN d > 0 THEN chars[d] END, 0) AS chars, d = coalesce(len(k), 0) AS ends
  FROM (SELECT conv_id, s.k, chars, unnest(range(0, coalesce(len(s.k), 0) + 1)) AS d FROM ids LEFT JOIN s USING (conv_id))
), n AS (
  SELECT d, k, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) * (count(*) - 1) AS saved,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM m GROUP BY d, k
), c AS (
  SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM n x WHERE x.d = n.d + 1 AND x.k[1 : n.d] = n.k) AS n_children
  FROM n LEFT JOIN n p ON p.d = n.d - 1 AND n.k[1 : p.d] = p.k
)
SELECT v.conv_id, v.d::BIGINT AS depth, v.parent_conv_id, v.n_convs, v.n_children, count_if(u.n_children = 0)::BIGINT AS n_leaves,
  sum(u.saved)::BIGINT AS saved_tokens, v.ends_sha256
FROM c v JOIN c u ON u.d >= v.d AND u.k[1 : v.d] = v.k GROUP BY ALL""")
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, convs = trie.with_shared_heads(trie.ordered_turns(table(spark, sf_dir, "conversations")))
    return trie.prefix_trie(turns, convs)


@query("op13_tokenizer_alignment")
def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.token_alignment(table(spark, sf_dir, "documents"), *paths)
