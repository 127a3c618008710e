"""Registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_path

from . import (decontaminate, embedding_dedup, importance, language_id, line_dedup, mixing, ngram_join, packing,
               source_audit, suffix_dedup, token_counts, token_output, url_filter)
from .common import read, ship

URL_RULES = [
    url_filter.Rule("net", "/", "block"),
    url_filter.Rule("example.net", "/en/", "allow"),
    url_filter.Rule("example.com", "/de/", "block"),
    url_filter.Rule("org", "/fr/", "allow"),
]


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of every embedding with others of its label at cosine 0.93 or more."""
    return embedding_dedup.link_vectors(read(spark, sf_dir, "embeddings"), 0.93)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document covered by 200-byte strings that stand elsewhere too."""
    return suffix_dedup.remove_repeats(read(spark, sf_dir, "documents"), 200)


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bloom filter cascades over every page's url."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def held_out(doc_id: str = "doc_id") -> F.Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PPM language of every document, learned from the rows that are not held out."""
    docs = read(spark, sf_dir, "documents")
    model = language_id.fit(docs.where(~held_out()))
    return language_id.predict(docs.select("doc_id", "text", held_out().alias("held_out")), model).drop("text")


def tokenizer_file(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under the 32k piece vocabulary."""
    vocabulary = token_counts.load_piece_model(tokenizer_file("piece_bpe_32k.model"))
    return token_counts.count_tokens(read(spark, sf_dir, "documents"), vocabulary)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document left when one line of each group of similar lines is kept."""
    return line_dedup.drop_lines(read(spark, sf_dir, "documents"))


def op7_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, bit-packed, written and read back."""
    path = scratch_path(spark, "token-ids")
    token_output.write_ids(read(spark, sf_dir, "documents"), path, tokenizer_file("byte_bpe_50k.json"), end_id=2)
    return token_output.read_documents(spark, path)


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents whose 5-word shingle sets have a Jaccard similarity of 0.75 or more."""
    return ngram_join.link_sets(read(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's copies in a mix of the corpus's size, no source repeated more than twice."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mix = mixing.plan(docs, budget_ratio=1.0, max_repeats=2.0)
    return (mixing.allot(docs, mix).withColumn("n_tokens", mixing.word_count(F.col("text"))).drop("text"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """10-word windows of the benchmark found in every document."""
    found = decontaminate.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.col("n_words").cast("bigint").alias("n_words"), "n_hit",
                        F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces, packed into sequences of at most 4096 tokens."""
    return packing.pack(read(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), end_id=1, limit=4096)


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's weight towards the benchmark, and the 5 % drawn by it."""
    rows = importance.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), n=3, buckets=10_000,
                               percent=5, least_words=20, seed=42)
    return rows.select("doc_id", "n_features", "weight", "score", "rank")


def op13_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of every language's sources from each other, and the terms that tell them apart."""
    return source_audit.audit(read(spark, sf_dir, "documents"), least=3, top=200)


_QUERIES = (op1_embedding_dedup, op2_suffix_dedup, op3_url_filter, op4_language_id, op5_token_counts, op6_line_dedup,
            op7_token_output, op8_ngram_join, op9_decontaminate, op10_mixing, op11_packing, op12_importance,
            op13_source_audit)


def _shipped(query):
    @functools.wraps(query)
    def run(spark, sf_dir):
        ship(spark)
        return query(spark, sf_dir)
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: _shipped(f) for f in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return {
        "op3_url_filter": r"""
            WITH parts AS (
                SELECT page_id,
                       CASE WHEN contains(url, '://') THEN translate(
                           regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*'),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
                       CASE WHEN contains(url, '://') THEN regexp_extract(
                           substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
                FROM pages),
            rules(h, p, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
            judged AS (
                SELECT parts.*, h || p AS rule, verdict,
                       row_number() OVER (PARTITION BY parts.rid ORDER BY length(h || p) DESC NULLS LAST) AS nth
                FROM (SELECT *, row_number() OVER () AS rid FROM parts) AS parts
                LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
            SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM judged WHERE nth = 1""",
        "op9_decontaminate": r"""
            WITH d AS (
                SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
            b AS (
                SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
            win AS (
                SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS win
                FROM (SELECT item_id, w, least(10, len(w)) AS k,
                             unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
                      FROM b WHERE len(w) > 0)),
            ks AS (SELECT DISTINCT k FROM win),
            spot AS (
                SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS win
                FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
                      FROM d, ks WHERE len(w) >= k)),
            hit AS (SELECT doc_id, i, spot.k, item_id FROM spot JOIN win ON spot.k = win.k AND spot.win = win.win),
            covered AS (
                SELECT doc_id, count(DISTINCT p) AS n_hit
                FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY doc_id),
            items AS (
                SELECT doc_id, count(DISTINCT item_id) AS n_items,
                       array_to_string(list_sort(list(DISTINCT CAST(item_id AS VARCHAR))), ',') AS ids
                FROM hit GROUP BY doc_id)
            SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
                   sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
            FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)""",
        # bucket of a feature: the table-driven CRC-32 over its bytes
        "op12_importance": r"""
            WITH tab AS (
                SELECT list(list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1
                    THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS t
                FROM (SELECT unnest(range(256)) AS b)),
            d AS (
                SELECT row_number() OVER () AS rid, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
            b AS (
                SELECT list_filter(string_split_regex(translate(coalesce(text, ''),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
            df AS (
                SELECT rid, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
                    list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS f FROM d),
            bf AS (
                SELECT unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
                    list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS f FROM b),
            dn AS (SELECT f, count(*) AS n FROM df GROUP BY f),
            bn AS (SELECT f, count(*) AS n FROM bf GROUP BY f),
            names AS (SELECT f, hex(encode(f)) AS h FROM (SELECT f FROM dn UNION SELECT f FROM bn)),
            coded AS (
                SELECT f, xor(list_reduce(list_concat([4294967295], list_transform(range(1, len(h), 2),
                    lambda i: CAST('0x' || substr(h, i, 2) AS BIGINT))), lambda c, x: xor(c >> 8, t[1 + (xor(c, x) & 255)])),
                    4294967295) % 10000 AS bucket
                FROM names, tab),
            s AS (SELECT bucket, sum(n) AS n FROM dn JOIN coded USING (f) GROUP BY bucket),
            t AS (SELECT bucket, sum(n) AS n FROM bn JOIN coded USING (f) GROUP BY bucket),
            totals AS (SELECT (SELECT coalesce(sum(n), 0) FROM s) AS all_s, (SELECT coalesce(sum(n), 0) FROM t) AS all_t),
            gain AS (
                SELECT k AS bucket, CAST(floor(1000 * ln((CAST(coalesce(t.n, 0) + 1 AS DOUBLE) * (all_s + 10000)) /
                    (CAST(coalesce(s.n, 0) + 1 AS DOUBLE) * (all_t + 10000)))) AS BIGINT) AS gain
                FROM (SELECT unnest(range(10000)) AS k), totals LEFT JOIN s ON s.bucket = k LEFT JOIN t ON t.bucket = k),
            weights AS (
                SELECT rid, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS weight
                FROM df JOIN coded USING (f) JOIN gain USING (bucket) GROUP BY rid),
            scored AS (
                SELECT rid, doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
                       coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('42:' ||
                           coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296)))
                           AS BIGINT) AS score
                FROM d LEFT JOIN weights USING (rid)),
            drawn AS (
                SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS rank,
                       5 * count(*) OVER () // 100 AS most
                FROM scored WHERE n_words >= 20)
            SELECT doc_id, n_features, weight, score, CASE WHEN rank <= most THEN rank END AS rank
            FROM scored LEFT JOIN drawn USING (rid)""",
        "op13_source_audit": r"""
            WITH d AS (
                SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                       list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
                FROM documents),
            c AS (
                SELECT lang, source, rid, term, count(*) AS n
                FROM (SELECT lang, source, rid, unnest(w) AS term FROM d) GROUP BY ALL),
            kept AS (SELECT lang, term, sum(n) AS lang_n FROM c GROUP BY ALL HAVING count(*) >= 3),
            v AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM kept GROUP BY lang),
            g AS (SELECT DISTINCT lang, source FROM d),
            n AS (SELECT lang, source, term, sum(n) AS n FROM c GROUP BY ALL),
            p AS (
                SELECT lang, source, term, coalesce(n, 0) AS n,
                       CAST(1 + (1000000000 * (coalesce(n, 0) + 1)) //
                           (sum(coalesce(n, 0)) OVER (PARTITION BY lang, source) + v) AS BIGINT) AS p,
                       CAST(1 + (1000000000 * (lang_n + 1)) // (lang_total + v) AS BIGINT) AS q
                FROM g JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN n USING (lang, source, term)),
            pairs AS (
                SELECT lang, a.source AS source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
                FROM p AS a JOIN p AS b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL),
            parts AS (
                SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
                FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source
                LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
                UNION ALL
                SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE n > 0 AND p > q),
            ranked AS (
                SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
                FROM parts)
            SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200""",
    }
