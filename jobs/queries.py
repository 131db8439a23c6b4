"""The jobs as registered queries, and their DuckDB SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from alembiq.plans.oracle import chain
from alembiq.shared import shared_dir

from . import reaction_intake, source_overlap


def folder(spark: SparkSession, name: str) -> str:
    """A new folder of the shared one; it stays."""
    return f"{shared_dir(spark)}/jobs/{name}-{uuid.uuid4().hex}"


def job1_reaction_intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over the order tables; the second finds nothing new."""
    output = folder(spark, "reaction_intake")
    for _ in range(2):
        reaction_intake.reaction_intake(spark, sf_dir, output)
    return reaction_intake.current(spark, output)


def job2_source_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over the files of documents; the second finds no new one."""
    output = folder(spark, "source_overlap")
    for _ in range(2):
        source_overlap.source_overlap(spark, f"{sf_dir}/documents.parquet", output)
    return source_overlap.current(spark, output)


INTAKE = chain(
    "keys",
    "SELECT 'reaction' AS kind, keys.ord, rxn_id, h AS reaction_hash_v1, cid AS cond_hash, copies, NULL::VARCHAR AS failure, 0::BIGINT AS load FROM keys JOIN firsts USING (h)"
    " UNION ALL SELECT 'failure', ord, rxn_id, NULL, NULL, NULL, 'missing_reaction_components', 0 FROM norm WHERE failed",
)

OVERLAP = """
WITH r AS (SELECT coalesce(lang, 'unknown') AS lang, coalesce(source, 'unknown') AS source, CASE WHEN trim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) <> '' THEN text END AS text FROM documents),
k AS (SELECT lang, source, 'text' AS kind, text AS id FROM r WHERE text IS NOT NULL UNION ALL SELECT lang, source, 'opening', split_part(text, chr(10), 1) FROM r WHERE text IS NOT NULL),
g AS (SELECT lang, source, kind, id, count(*) AS n FROM k GROUP BY lang, source, kind, id),
c AS (SELECT *, count(*) OVER (PARTITION BY lang, kind, id) > 1 AS shared FROM g),
o AS (SELECT lang, source, count(*) AS n_openings, -sum(n / total * log2(n / total)) AS ent, max(n / total) AS top FROM
 (SELECT *, (sum(n) OVER (PARTITION BY lang, source))::DOUBLE AS total FROM c WHERE kind = 'opening') GROUP BY lang, source),
s AS (SELECT lang, source, count(*) FILTER (kind = 'text') AS n_texts, count(*) FILTER (kind = 'text' AND shared) AS n_shared_texts, count(*) FILTER (kind = 'opening' AND shared) AS n_shared_openings FROM c GROUP BY lang, source),
b AS (SELECT lang, source, count(*) AS n_rows, count(*) FILTER (text IS NULL) AS n_missing FROM r GROUP BY lang, source)
SELECT 'source' AS kind, lang, source, NULL::VARCHAR AS target, n_rows, n_missing, coalesce(n_texts, 0) AS n_texts, coalesce(n_openings, 0) AS n_openings, abs(round(coalesce(ent, 0), 6)) AS opening_entropy,
 round(coalesce(top, 0), 6) AS top_opening_share, coalesce(n_shared_texts, 0) AS n_shared_texts, coalesce(n_shared_openings, 0) AS n_shared_openings, NULL::BIGINT AS n_shared, NULL::BIGINT AS weight
FROM b LEFT JOIN s USING (lang, source) LEFT JOIN o USING (lang, source)
UNION ALL SELECT a.kind, a.lang, a.source, z.source, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, count(*), sum(least(a.n, z.n))::BIGINT
FROM c a JOIN c z ON a.lang = z.lang AND a.kind = z.kind AND a.id = z.id AND a.source < z.source GROUP BY 1, 2, 3, 4"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (job1_reaction_intake, job2_source_overlap)}


def oracle_sql() -> dict[str, str]:
    return {"job1_reaction_intake": INTAKE, "job2_source_overlap": OVERLAP}
