"""Condition keys: binned conditions under one hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import parsing as p
from ..functions import units
from ..functions.hashing import hex_digest, parity_json
from . import profile


def condition_keys(reactions: DataFrame, hash_mode: str = "sha2", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per normalized reaction with its bins, keys, cond_hash and its 8-digit prefix, and the columns ``keep``. No shuffle."""
    scalar = lambda c: F.lower(p.blank_to_null(F.col(c).cast("string")))
    keyed = reactions.select(
        "rxn_vid",
        "present_mask",
        units.bin_temperature(F.col("temperature_K")).alias("temp_K_bin"),
        units.bin_decade(F.col("time_s")).alias("time_s_bin"),
        units.bin_decade(F.col("pressure_Pa")).alias("pressure_Pa_bin"),
        units.bin_ph(F.col("pH")).alias("pH_bin"),
        scalar("atmosphere").alias("atmosphere"),
        scalar("light").alias("light"),
        scalar("phase").alias("phase"),
        p.key_json(F.col("solvent_normalized"), pairs=True).alias("solvent_key"),
        p.key_json(F.col("agents_canonical")).alias("catalyst_key"),
        p.key_json(F.col("spectators_moved")).alias("agent_key"),
        F.col("resolution_confidence"),
        *keep,
    )

    def quoted(c: Column) -> Column:
        """A JSON string; escapes are written where there is something to escape."""
        listed = F.to_json(F.array(c))
        text = F.when(c.rlike(r'["\\\x00-\x1f]'), F.substring(listed, F.lit(2), F.length(listed) - 2)).otherwise(F.concat(F.lit('"'), c, F.lit('"')))
        return F.coalesce(F.when(c.isNotNull(), text), F.lit("null"))

    parts = [
        F.col("solvent_key"),
        *[quoted(F.col(c)) for c in ("temp_K_bin", "time_s_bin", "pressure_Pa_bin", "pH_bin", "atmosphere", "light", "phase")],
        F.col("catalyst_key"),
        F.col("present_mask").cast("string"),
    ]
    text = F.concat(F.lit("["), F.concat_ws(",", *parts), F.lit("]"))
    text = parity_json(text) if hash_mode == "parity" else text
    hashed = keyed.withColumn("cond_hash", hex_digest(text, hash_mode))
    rest = [c for c in keyed.columns if c != "rxn_vid"]
    return hashed.select("rxn_vid", "cond_hash", F.substring("cond_hash", 1, 8).alias("cond_hash_prefix"), *rest)


def condition_sizes(normalized: DataFrame, hash_mode: str = "sha2") -> DataFrame:
    """(cond_hash, n): deduplicated reactions of each condition, straight from ``normalize``'s rows.

    The key needs no rxn_vid, so that nothing is numbered and only two hashes
    are shuffled: the first row of a reaction hash decides its condition.
    """
    whole = F.when(F.size("failures") == 0, F.col("reaction_hash_v1"))
    keyed = condition_keys(normalized.withColumns({"rxn_vid": F.col("ord"), "whole": whole}), hash_mode, ("whole",))
    first = keyed.groupBy("whole").agg(F.min_by("cond_hash", "rxn_vid").alias("cond_hash")).filter("whole is not null")
    return first.groupBy("cond_hash").agg(F.count("*").alias("n"))


def level1_members(keys: DataFrame) -> DataFrame:
    """(CID, rxn_vid): the members of level-1 clusters one by one, which no hot condition outgrows."""
    return keys.select(F.col("cond_hash").alias("CID"), "rxn_vid")


def level1_clusters(keys: DataFrame) -> DataFrame:
    """(CID, rxn_vids): CID is cond_hash. For conditions whose members fit a row; ``level1_members`` has no such bound."""
    return keys.groupBy(F.col("cond_hash").alias("CID")).agg(F.array_sort(F.collect_list("rxn_vid")).alias("rxn_vids"))


REPORTED = ("cond_hash", "cond_hash_prefix", "present_mask", "temp_K_bin", "time_s_bin", "pressure_Pa_bin", "pH_bin", "solvent_key", "catalyst_key", "agent_key")


def usage(keys: DataFrame, limit: int = 5) -> DataFrame:
    """The commonest hashes, masks, bins and keys."""
    return profile.usage(keys, {c: F.col(c) for c in REPORTED}, limit)


def summary(keys: DataFrame) -> DataFrame:
    return keys.agg(
        F.count("*").alias("n_rows"),
        F.count_distinct("cond_hash").alias("n_conditions"),
        F.round(F.avg("resolution_confidence"), 6).alias("mean_confidence"),
        F.round(F.median("resolution_confidence"), 6).alias("median_confidence"),
    )
