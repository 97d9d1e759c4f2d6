"""Helpers shared by the operators: tables, stored steps, names that cannot clash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from maskwright.sources.scratch import new_folder


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared checkpoint folder and read again: its lineage ends
    there, later steps reuse it, and the loss of an executor costs nothing."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def column(df: DataFrame, name: str) -> Column:
    """A column by its exact name, dots and all."""
    return df["`" + name.replace("`", "``") + "`"]


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def free_name(df: DataFrame, wish: str) -> str:
    """``wish``, or it with underscores added until no column of ``df`` has that name."""
    taken = {name.lower() for name in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id's text leaves this remainder. A null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))
