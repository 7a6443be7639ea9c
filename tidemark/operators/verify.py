"""Was every file stored as it was read?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.paths import is_encrypted
from tidemark.schemas import require_columns


def check_status(source_md5: Column, target_md5: Column, exempt: Column | None = None) -> Column:
    """``verified``, ``mismatch``, or ``exempt`` for an encrypted file without a digest to compare."""
    exempt = F.lit(False) if exempt is None else exempt
    return (
        F.when(source_md5 == target_md5, "verified")
        .when(exempt & (source_md5.isNull() | target_md5.isNull()), "exempt")
        .otherwise("mismatch")
    )


def verify(source: DataFrame, target: DataFrame, key: str = "relpath", digest: str = "md5",
           unique: bool = False) -> DataFrame:
    """Compare two sides by path; every path of either side comes out once.

    Adds ``missing`` (only at the source) and ``unexpected`` (only at the
    target). A path that occurs more than once counts as verified only when
    all its digests agree.

    Where each side is known to hold a path once, as a listing does,
    ``unique`` compares by one full join, at about half the cost. Otherwise
    both sides go through one aggregation by path, which combines before its
    shuffle: a path repeated many times is one row per task.
    """
    require_columns(source, [key, digest], "verify source")
    require_columns(target, [key, digest], "verify target")
    compared = (_join_sides if unique else _group_sides)(
        source.select(key, F.col(digest).alias("digest")), target.select(key, F.col(digest).alias("digest")), key
    )
    check = (
        F.when(~F.col("at_target"), "missing")
        .when(~F.col("at_source"), "unexpected")
        .when(F.col("complete") & F.col("agree"), "verified")
        .when(~F.col("complete") & is_encrypted(key), "exempt")
        .otherwise("mismatch")
    )
    return compared.select(key, "md5_source", "md5_target", check.alias("check"))


def _join_sides(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    sides = source.select(key, F.col("digest").alias("md5_source"), F.lit(True).alias("at_source")).join(
        target.select(key, F.col("digest").alias("md5_target"), F.lit(True).alias("at_target")), key, "full_outer"
    )
    return sides.select(
        key,
        "md5_source",
        "md5_target",
        F.coalesce("at_source", F.lit(False)).alias("at_source"),
        F.coalesce("at_target", F.lit(False)).alias("at_target"),
        (F.col("md5_source").isNotNull() & F.col("md5_target").isNotNull()).alias("complete"),
        (F.col("md5_source") == F.col("md5_target")).alias("agree"),
    )


def _group_sides(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    of_source = F.col("of_source")
    sides = source.withColumn("of_source", F.lit(True)).unionByName(target.withColumn("of_source", F.lit(False)))
    return sides.groupBy(key).agg(
        F.min(F.when(of_source, F.col("digest"))).alias("md5_source"),
        F.min(F.when(~of_source, F.col("digest"))).alias("md5_target"),
        (F.count_if(of_source) > 0).alias("at_source"),
        (F.count_if(~of_source) > 0).alias("at_target"),
        (F.count("digest") == F.count("*")).alias("complete"),
        (F.min("digest") == F.max("digest")).alias("agree"),
    )


def lookup_objects(manifest: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Each manifest row with what the store holds under its key; ``found`` tells whether it does.

    The stored side is reduced to one row per key first, so the join never
    multiplies rows.
    """
    others = [name for name in stored.columns if name not in keys]
    newest = stored.groupBy(*keys).agg(F.max(F.struct(*others)).alias("stored"))
    return manifest.join(newest, keys, "left").select(
        *[manifest[name] for name in manifest.columns],
        F.col("stored").isNotNull().alias("found"),
        *[F.col(f"stored.{name}").alias(f"stored_{name}") for name in others],
    )
