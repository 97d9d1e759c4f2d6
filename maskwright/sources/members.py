"""Made-up members: an id, two names, a phone number and a parent's name.

Every value follows from the row's id and the seed alone. So the table is the
same however it is partitioned, and a recomputed partition gives the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from maskwright.functions.keyed import as_column

FIRST_NAMES = (
    "Ada", "Amir", "Bela", "Chen", "Dara", "Elif", "Femi", "Goran", "Hana", "Ines",
    "Jonas", "Kira", "Lena", "Malik", "Noor", "Olga", "Pavel", "Rosa", "Sven", "Tara",
)
LAST_NAMES = (
    "Alder", "Birch", "Cedar", "Dogwood", "Elder", "Fir", "Ginkgo", "Hazel",
    "Juniper", "Larch", "Maple", "Oak", "Pine", "Rowan", "Spruce", "Willow",
)


def members(
    spark: SparkSession,
    count: int,
    *,
    seed: int = 0,
    first_names: Sequence[str] = FIRST_NAMES,
    last_names: Sequence[str] = LAST_NAMES,
) -> DataFrame:
    """That many members, made on the executors."""
    ids = spark.range(count)
    return ids.select(
        *member_columns("id", seed=seed, first_names=first_names, last_names=last_names)
    )


def member_columns(
    id: Column | str,
    *,
    seed: int = 0,
    first_names: Sequence[str] = FIRST_NAMES,
    last_names: Sequence[str] = LAST_NAMES,
) -> list[Column]:
    """The five member fields, made from an id column of any table."""
    id = as_column(id).cast("string")

    def pick(purpose: str, length: int) -> Column:
        """An evenly spread number of that many decimal digits."""
        digest = F.md5(F.concat(F.lit(f"{seed}:{purpose}:"), id))
        number = F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")
        return F.lpad((number % 10**length).cast("string"), length, "0")

    def name(purpose: str, names: Sequence[str]) -> Column:
        place = pick(purpose, 9).cast("int") % len(names)
        return F.element_at(F.array(*map(F.lit, names)), place + 1)

    digits = pick("phone", 10)
    phone = F.concat_ws("-", *[F.substring(digits, a, n) for a, n in ((1, 3), (4, 3), (7, 4))])
    return [
        pick("member", 16).alias("member_id"),
        name("first", first_names).alias("first_name"),
        name("last", last_names).alias("last_name"),
        phone.alias("phone_number"),
        name("parent", last_names).alias("parent_name"),
    ]
