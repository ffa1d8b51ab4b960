"""One query per operator over the driver's tables, and SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visittrail.llm import (
    decontaminate,
    divergence,
    linededup,
    packing,
    permutation,
    pii,
    simhash,
    token_output,
    tokencount,
    toxicity,
    urlfilter,
    warc,
    whitening,
)
from visittrail.llm.urls import url_key

TOKENIZER = "word_bpe_49k.json"
COUNTED_TOKENIZER = "byte_bpe_50k.json"
SEQUENCE = 4096
RULES = (
    ("net", "/", "block"), ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives, looked up by its URL in the index, and read back."""
    pages = _table(spark, sf_dir, "pages")
    archive = warc.write_archive(pages)
    keys = pages.select(F.coalesce(url_key(F.col("url")), F.lit(")")).alias("url_key"))
    records = warc.read_records(archive, warc.lookup(archive, keys))
    return warc.digests(records)


def op2_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation.nearest_neighbours(
        _table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0, top=20)


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(_table(spark, sf_dir, "documents"))
    counts = (
        pii.count_of("base", k).alias(f"n_{k}") for k in pii.KINDS)
    both = F.array_sort(F.concat("base", "added"))
    return found.select(
        "doc_id", *counts, F.sha2(pii.written(F.col("base")), 256).alias("base_sha256"),
        pii.written(both).alias("spans"), F.size("added").cast("long").alias("n_added"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(
        _table(spark, sf_dir, "documents"), shingle=3, distance=3)
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.write_packed(
        _table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), length=SEQUENCE)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return linededup.line_dedup(docs, dropped="n_dropped").select("doc_id", "n_dropped", "text")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return urlfilter.judged(_table(spark, sf_dir, "pages"), rules, keep=("page_id",))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(
        _table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), length=SEQUENCE)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(_table(spark, sf_dir, "documents"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(
        _table(spark, sf_dir, "documents"), public_tokenizers.path(COUNTED_TOKENIZER), limit=1024)


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(_table(spark, sf_dir, "embeddings"), components=16).select(
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")


QUERIES = {f.__name__: f for f in (
    op1_warc, op2_permutation_index, op3_personal_data, op4_decontamination, op5_simhash,
    op6_token_output, op7_line_dedup, op8_url_filter, op9_best_fit_packing, op10_toxicity,
    op11_source_divergence, op12_token_counts, op13_embedding_whitening,
)}

_WORDS = (
    "regexp_extract_all(translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

SQL = {
    "op1_warc": """
        WITH p AS (
            SELECT page_id, encode(coalesce(html, '')) AS b FROM pages
        ), d AS (
            SELECT page_id, octet_length(b) AS payload_bytes, sha256(b) AS payload_digest FROM p
        ), f AS (
            SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND first <> page_id THEN 'revisit'
                    ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND first <> page_id THEN first END AS refers_to
        FROM f""",
    "op4_decontamination": f"""
        WITH d AS (SELECT doc_id, {_WORDS.format('text')} AS w FROM documents),
        i AS (SELECT item_id, {_WORDS.format('text')} AS w FROM benchmark),
        wins AS (
            SELECT item_id, 10 AS n, array_to_string(w[p:p + 9], ' ') AS g
            FROM i, unnest(range(1, len(w) - 8)) AS t(p) WHERE len(w) >= 10
            UNION ALL
            SELECT item_id, len(w), array_to_string(w, ' ') FROM i WHERE len(w) BETWEEN 1 AND 9
        ),
        sizes AS (SELECT DISTINCT n FROM wins),
        runs AS (
            SELECT doc_id, p, n, array_to_string(w[p:p + n - 1], ' ') AS g
            FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS t(p)
        ),
        found AS (
            SELECT r.doc_id, r.p, r.n, x.item_id FROM runs r JOIN wins x ON r.n = x.n AND r.g = x.g
        ),
        hit AS (
            SELECT doc_id, count(DISTINCT p + k) AS n_hit
            FROM (SELECT DISTINCT doc_id, p, n FROM found), unnest(range(0, n)) AS t(k)
            GROUP BY doc_id
        ),
        items AS (
            SELECT doc_id, count(*) AS n_items,
                   sha256(string_agg(item_id, ',' ORDER BY item_id)) AS items_sha256
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM found)
            GROUP BY doc_id
        )
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
               coalesce(n_items, 0) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op7_line_dedup": f"""
        WITH p AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS l FROM documents),
        totals AS (SELECT source, count(DISTINCT text) AS pages FROM p GROUP BY source),
        lines AS (
            SELECT DISTINCT source, text, unnest(l) AS line FROM p
        ),
        bad AS (
            SELECT source, line FROM lines JOIN totals USING (source)
            WHERE trim(line, ' ') <> ''
            GROUP BY source, line, pages
            HAVING count(*) >= {linededup.LEAST_PAGES} AND count(*) > {linededup.RATIO} * pages
        ),
        lists AS (SELECT source, list(line) AS bad FROM bad GROUP BY source)
        SELECT doc_id,
               CAST(len(list_filter(coalesce(l, []), lambda x: list_contains(coalesce(bad, []), x)))
                    AS BIGINT) AS n_dropped,
               CASE WHEN text IS NULL THEN NULL ELSE array_to_string(list_filter(
                   l, lambda x: NOT list_contains(coalesce(bad, []), x)), chr(10)) END AS text
        FROM p LEFT JOIN lists USING (source)""",
    "op8_url_filter": r"""
        WITH u AS (
            SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0
                            THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
            FROM pages
        ), h AS (
            SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM u
        ), rules(rh, rp, v) AS (
            VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                   ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
        ), fits AS (
            SELECT page_id, rh || rp AS rule, v,
                   row_number() OVER (PARTITION BY page_id ORDER BY length(rh || rp) DESC) AS n
            FROM h JOIN rules ON (host = rh OR ends_with(host, '.' || rh))
                             AND starts_with(path, rp)
        )
        SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict
        FROM h LEFT JOIN (SELECT * FROM fits WHERE n = 1) USING (page_id)""",
    "op11_source_divergence": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang,
                   coalesce(source, '') AS source,
                   regexp_extract_all(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
            FROM documents
        ), t AS (
            SELECT r, lang, source, unnest(words) AS term FROM d
        ), kept AS (
            SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 30
        ), v AS (
            SELECT lang, count(*) AS v FROM kept GROUP BY lang
        ), g AS (
            SELECT DISTINCT lang, source FROM d
        ), counted AS (
            SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term)
            GROUP BY lang, source, term
        ), filled AS (
            SELECT g.lang, g.source, kept.term, coalesce(n, 0) AS n
            FROM g JOIN kept USING (lang) LEFT JOIN counted USING (lang, source, term)
        ), p AS (
            SELECT lang, source, term, n, 1 + CAST(1000000000 AS HUGEINT) * (n + 5)
                   // (sum(n) OVER (PARTITION BY lang, source) + 5 * v) AS p
            FROM filled JOIN v USING (lang)
        ), whole AS (
            SELECT lang, term, sum(n) AS n FROM filled GROUP BY lang, term
        ), q AS (
            SELECT lang, term, 1 + CAST(1000000000 AS HUGEINT) * (n + 5)
                   // (sum(n) OVER (PARTITION BY lang) + 5 * v) AS q
            FROM whole JOIN v USING (lang)
        ), sums AS (
            SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
            FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
            GROUP BY a.lang, a.source, b.source
        ), found AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
                   CAST(coalesce(value, 0) AS BIGINT) AS value
            FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
            UNION ALL
            SELECT lang, source, 'term', term, CAST(p - q AS BIGINT)
            FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q
        ), ranked AS (
            SELECT *, CAST(row_number() OVER (
                PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
            FROM found
        )
        SELECT lang, source, part, item, value, rank FROM ranked
        WHERE part = 'pair' OR rank <= 50""",
}
