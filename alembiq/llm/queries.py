"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontam, exact_dedup, html_extract, langid, line_dedup, lm_score, secret_scan, simhash, substring_dedup, token_align, toxicity
from .util import documents

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


#: The vocabularies that op11 aligns.
ALIGNED = ("byte_bpe_50k.json", "piece_bpe_32k.model")


def tokenizer(name: str = VOCABULARY) -> tuple[str, str]:
    """(path of a public rank file, its pattern)."""
    import public_tokenizers

    return str(public_tokenizers.path(name)), public_tokenizers.PATTERN


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(documents(spark, sf_dir, "doc_id", "text", "lang"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir, "doc_id", "text")).drop("repeat")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(documents(spark, sf_dir, "doc_id", "text")))


def op4_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", F.col("html").cast("string").alias("html"))
    text = pages.select("page_id", "url", html_extract.main_text(F.col("html")).alias("text"))
    return text.withColumn("n_chars", F.length("text").cast("long"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(documents(spark, sf_dir, "doc_id", "text")).drop("fp", "root", "th")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(documents(spark, sf_dir, "doc_id", "text"), min_block_chars=1)
    return found.select("doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = tokenizer()
    coded = bpe.encode_texts(documents(spark, sf_dir, "doc_id", "text"), path, pattern, keep_ids=False)
    return coded.drop("ids")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.hits(documents(spark, sf_dir, "doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", decontam.items_digest(F.col("items")).alias("items_sha256"), "contaminated")


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = langid.held_out(5, 1)
    return lm_score.score_texts(documents(spark, sf_dir, "doc_id", "text"), ~held, held)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.drop_repeats(documents(spark, sf_dir, "doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    (a_path, pattern), (b_path, _) = map(tokenizer, ALIGNED)
    found = token_align.align_tokens(documents(spark, sf_dir, "doc_id", "text"), a_path, b_path, pattern, keep_groups=False)
    return found.drop("groups")


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(documents(spark, sf_dir, "doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (
        op1_language_id, op2_exact_dedup, op3_secret_scan, op4_html_extract, op5_simhash, op6_line_dedup, op7_bpe,
        op8_decontamination, op9_lm_score, op10_substring_dedup, op11_token_alignment, op12_toxicity, pipeline,
    )
    return {f.__name__: f for f in every}


EXACT = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text),
r AS (SELECT doc_id, text, row_number() OVER (PARTITION BY text, doc_id) AS n FROM t)
SELECT r.doc_id, g.keep_id, g.group_size, r.doc_id IS NOT DISTINCT FROM g.keep_id AND r.n = 1 AS kept, sha256(r.text) AS text_sha256
FROM r JOIN g USING (text)"""

CONTAMINATION = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bs AS (SELECT item_id, w, least(13, len(w)) AS n FROM b WHERE len(w) > 0),
bw AS (SELECT item_id, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS win FROM bs),
win AS (SELECT n, win, list(DISTINCT CAST(item_id AS VARCHAR)) AS items FROM bw GROUP BY n, win),
sizes AS (SELECT DISTINCT n FROM win),
dp AS (SELECT rid, n, unnest(range(1, len(w) - n + 2)) AS i, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS win FROM d, sizes WHERE len(w) >= n),
occ AS (SELECT dp.rid, dp.i, dp.n, win.items FROM dp JOIN win ON dp.win = win.win AND dp.n = win.n),
hit AS (SELECT rid, count(DISTINCT j) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS j FROM occ) GROUP BY rid),
its AS (SELECT rid, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM (SELECT rid, unnest(items) AS item FROM occ) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
 coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN its USING (rid)"""

REPEATS = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT rid, unnest(range(1, len(w) - 33)) AS i, unnest(list_transform(range(1, len(w) - 33), lambda i: md5(array_to_string(w[i:i + 34], ' ')))) AS win FROM d WHERE len(w) >= 35),
c AS (SELECT win FROM p GROUP BY win HAVING count(*) > 1),
s AS (SELECT rid, i FROM p JOIN c USING (win)),
x AS (SELECT rid, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM d),
m AS (SELECT x.rid, x.i, x.word, count(s.i) OVER (PARTITION BY x.rid ORDER BY x.i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) > 0 AS gone FROM x LEFT JOIN s ON x.rid = s.rid AND x.i = s.i),
k AS (SELECT rid, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM m GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (rid)"""


def oracle_sql() -> dict[str, str]:
    """SQL for the queries that DuckDB can express; the others are tested against brute force."""
    return {
        "op2_exact_dedup": EXACT,
        "op3_secret_scan": secret_scan.oracle(),
        "op8_decontamination": CONTAMINATION,
        "op10_substring_dedup": REPEATS,
    }
