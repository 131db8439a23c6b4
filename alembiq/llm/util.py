"""What several operators share: row keys, the documents table, and broadcast objects."""

from __future__ import annotations

import sys

from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared import cut, shared_dir

__all__ = ["cut", "documents", "free_name", "row_key", "share", "shared", "shared_dir", "text_or_empty"]

cloudpickle.register_pickle_by_value(sys.modules[__name__])

NO_ID = -(2**63)


def share(spark: SparkSession, value: object) -> Broadcast:
    """Broadcast an object's attributes.

    A broadcast names the class of what it holds, which a worker can import
    only where the package is installed; attributes are plain values.
    """
    return spark.sparkContext.broadcast(vars(value))


def shared(kind: type, held: Broadcast):
    """The object of class ``kind`` that ``share`` broadcast."""
    value = kind.__new__(kind)
    value.__dict__ = held.value
    return value


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def row_key(id_col: str = "doc_id", text_col: str = "text") -> list[Column]:
    """(did, th): the id, null as the least long, and XXH64 of the whole text.

    Rows that agree in both are the same document stored twice, and every
    operator gives them the same result.
    """
    return [
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("did"),
        F.xxhash64(text_or_empty(text_col)).alias("th"),
    ]


def free_name(df: DataFrame, name: str) -> str:
    """``name`` with underscores before it until no column of ``df`` is called so, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return df.select(*columns) if columns else df
