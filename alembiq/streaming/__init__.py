"""The row-local part of the pipeline over streams."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.conditions import condition_keys
from ..operators.normalize import normalize


def stream_conditions(raw: DataFrame) -> DataFrame:
    """Normalize a streaming frame of raw reactions and add condition keys.

    Deduplication and numbering need the whole table, so ``rxn_vid`` is the
    reaction hash's first 15 hex digits as a number here.
    """
    from pyspark.sql import functions as F

    good = normalize(raw).filter(F.size("failures") == 0)
    vid = F.conv(F.substring("reaction_hash_v1", 1, 15), 16, 10).cast("long")
    return condition_keys(good.withColumn("rxn_vid", vid))
