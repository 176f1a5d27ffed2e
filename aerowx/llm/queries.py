"""Queries over the driver's tables, and their DuckDB SQL where SQL can say
it.  Each query is a thin application of one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .binary_records import write_and_read
from .bisector_clusters import cluster
from .byte_bpe import encode_and_decode
from .common import table
from .exact_dedup import exact_dedup
from .hnsw import nearest
from .lang_id import language_id
from .minhash_dedup import near_dedup
from .mixing import mix
from .phrase_index import decontaminate
from .pii import replace_pii
from .secret_scan import secret_scan
from .spelling_variants import spelling_variants
from .token_counts import tokens_by_line


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    return language_id(table(spark, sf_dir, "documents"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again."""
    return encode_and_decode(table(spark, sf_dir, "documents"),
                             public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op3_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with personal data replaced."""
    return replace_pii(table(spark, sf_dir, "documents"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies among all documents, at 85 % of the shingles."""
    return near_dedup(table(spark, sf_dir, "documents"), 85)


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to 150 % of their words."""
    return mix(table(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents, with the ownership of their values."""
    return secret_scan(table(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact copies among all documents."""
    return exact_dedup(table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document."""
    return tokens_by_line(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                          public_tokenizers.PATTERN)


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every 20th vector among all."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_binary_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, written to record files and read back."""
    return write_and_read(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their near words, forms and roots."""
    return spelling_variants(table(spark, sf_dir, "documents"))


def op12_bisector_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors in 16 clusters after three rounds."""
    return cluster(table(spark, sf_dir, "embeddings"))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words that stand in a window of a benchmark item."""
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_pii_surrogates": op3_pii_surrogates,
    "op4_near_dedup": op4_near_dedup,
    "op5_source_mix": op5_source_mix,
    "op6_secret_scan": op6_secret_scan,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_token_counts": op8_token_counts,
    "op9_nearest": op9_nearest,
    "op10_binary_records": op10_binary_records,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_bisector_clusters": op12_bisector_clusters,
    "op13_decontamination": op13_decontamination,
}


def _clusters_sql(rounds: int = 3) -> str:
    """Every round as three steps: all distances, the nearest, the new centroids."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
        dist{i} AS (
          SELECT v.r, c.c, sum((v.x - c.x) * (v.x - c.x))::BIGINT AS d FROM cells v JOIN cent{i} c ON v.i = c.i GROUP BY ALL),
        near{i} AS (
          SELECT r, c, d FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY d, c) AS k FROM dist{i}) WHERE k = 1)""")
        if i < rounds:
            steps.append(f"""
        moved{i} AS (
          SELECT n.c, v.i, sum(v.x)::BIGINT AS s, count(*) AS n FROM near{i} n JOIN cells v ON n.r = v.r GROUP BY ALL),
        cent{i + 1} AS (
          SELECT c.c, c.i, CASE WHEN m.n IS NULL THEN c.x ELSE (m.s - ((m.s % m.n) + m.n) % m.n) // m.n END AS x
          FROM cent{i} c LEFT JOIN moved{i} m ON c.c = m.c AND c.i = m.i)""")
    return f"""
        WITH kept AS (
          SELECT row_number() OVER () AS r, vec_id, sha256('1:' || coalesce(vec_id::VARCHAR, '')) AS h,
                 list_transform(embedding, lambda x: floor(64.0 * x::DOUBLE)::BIGINT) AS v
          FROM embeddings WHERE len(embedding) = 64
            AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
        cells AS (SELECT r, unnest(range(64)) AS i, unnest(v) AS x FROM kept),
        cent0 AS (
          SELECT c, unnest(range(64)) AS i, unnest(v) AS x
          FROM (SELECT v, row_number() OVER (ORDER BY h, v) - 1 AS c FROM kept ORDER BY h, v LIMIT 16)),
        {",".join(steps)},
        facts AS (
          SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM cent{rounds} GROUP BY c)
        SELECT vec_id, n.c::INTEGER AS cluster, d AS distance, sum(d) OVER (PARTITION BY n.c)::BIGINT AS cluster_inertia,
               sum(d) OVER ()::BIGINT AS inertia, centroid_sha256
        FROM near{rounds} n JOIN kept k ON n.r = k.r JOIN facts f ON n.c = f.c"""


ORACLE_SQL = {
    "op5_source_mix": r"""
        WITH sized AS (
          SELECT doc_id, source, md5('mix-1:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS place,
                 len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
          FROM documents),
        src AS (
          SELECT source, sum(size)::BIGINT AS source_size, 2.0::DOUBLE * sum(size)::DOUBLE AS cap,
                 [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
          FROM sized GROUP BY source),
        filled AS (  -- k sources capped, in the order in which they fill up
          SELECT *, row_number() OVER f AS k, sum(cap) OVER f AS caps, sum(weight) OVER f AS gone
          FROM src WINDOW f AS (ORDER BY cap / weight, source NULLS LAST)),
        sums AS (SELECT 1.5::DOUBLE * sum(source_size)::DOUBLE AS want, sum(weight) AS all_weight FROM src),
        levels AS (
          SELECT 0 AS k, want / all_weight AS level FROM sums
          UNION ALL
          SELECT k, (want - caps) / (all_weight - gone) FROM filled, sums WHERE all_weight > gone),
        fits AS (  -- the first level that no open source is above
          SELECT min_by(level, l.k) AS level FROM levels l
          WHERE NOT EXISTS (SELECT 1 FROM filled f WHERE f.k > l.k AND f.weight * l.level > f.cap)),
        targets AS (
          SELECT source, source_size, CASE WHEN weight * level >= cap THEN cap ELSE weight * level END AS target
          FROM src, fits),
        cut AS (
          SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM targets),
        placed AS (
          SELECT s.*, c.source_size, c.target, c.whole, c.target - c.whole * c.source_size AS rest,
                 sum(s.size) OVER (PARTITION BY s.source ORDER BY s.place ROWS UNBOUNDED PRECEDING) - s.size / 2.0 AS mid
          FROM sized s JOIN cut c ON s.source IS NOT DISTINCT FROM c.source),
        taking AS (
          SELECT *, (whole + CASE WHEN mid < rest THEN 1 ELSE 0 END)::INTEGER AS repetitions FROM placed)
        SELECT doc_id, size, source_size, target, size * repetitions AS taken, repetitions FROM taking""",
    "op7_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
    "op12_bisector_clusters": _clusters_sql(),
    "op13_decontamination": r"""
        WITH docs AS (
          SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
          FROM documents),
        items AS (
          SELECT row_number() OVER () AS t, coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(translate(coalesce(text, ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
          FROM benchmark),
        words AS (SELECT r, unnest(ws) AS w, unnest(range(len(ws))) AS p FROM docs),
        wins AS (
          SELECT t, item, o, size, list_slice(ws, o + 1, o + size) AS ws
          FROM (SELECT *, least(10, len(ws)) AS size, unnest(range(len(ws) - least(10, len(ws)) + 1)) AS o
                FROM items WHERE len(ws) > 0)),
        grams AS (
          SELECT r, p, size, list_slice(ws, p + 1, p + size) AS ws
          FROM (SELECT d.*, size, unnest(range(len(d.ws) - size + 1)) AS p
                FROM docs d, (SELECT DISTINCT size FROM wins) WHERE len(d.ws) >= size)),
        occ AS (SELECT r, p, item, g.size FROM grams g JOIN wins w ON g.size = w.size AND g.ws = w.ws),
        hit AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + size)) AS q FROM occ) GROUP BY r),
        of_doc AS (
          SELECT r, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
          FROM (SELECT DISTINCT r, item FROM occ) GROUP BY r),
        -- windows whose words all stand within two places, seen from the rarest
        win_words AS (SELECT t, item, o, size, unnest(ws) AS w, unnest(range(size)) AS i FROM wins),
        rarity AS (SELECT w, count(*) AS n FROM words GROUP BY w),
        rarest AS (
          SELECT t, o, arg_min(i, (n, i)) AS i1, arg_min(w, (n, i)) AS w1 FROM win_words JOIN rarity USING (w) GROUP BY t, o),
        seen AS (SELECT k.t, k.o, k.i1, x.r, x.p FROM rarest k JOIN words x ON x.w = k.w1),
        near AS (
          SELECT s.r, v.item FROM seen s JOIN win_words v ON s.t = v.t AND s.o = v.o
          JOIN words x ON x.r = s.r AND x.w = v.w AND abs(x.p - (s.p + v.i - s.i1)) <= 2
          GROUP BY s.t, s.o, s.r, s.p, v.item, v.size HAVING count(DISTINCT v.i) = v.size),
        near_doc AS (SELECT r, count(DISTINCT item) AS n_near_items FROM near GROUP BY r)
        SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
               coalesce(n_near_items, 0) AS n_near_items
        FROM docs LEFT JOIN hit USING (r) LEFT JOIN of_doc USING (r) LEFT JOIN near_doc USING (r)""",
}
