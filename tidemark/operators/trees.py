"""Audits of whole trees by digests of folders.

A folder's digest is made of its files' paths and digests in any order: how many there are, two exclusive ors of hashes of 64 bits,
and a sum, which sees what cancels out in those. It combines before the shuffle, so a side costs one row a folder and task. Digests of
sub-trees are those of their folders put together. Files of folders that agree on both sides are verified without being
shuffled; only the others are compared one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.verify import verify
from tidemark.schemas import require_columns

_PARTS = ("files", "unread", "xor_low", "xor_high", "total")


def folder_of(relpath: str | Column) -> Column:
    """The folder of a file below the root, without a slash at its end; the root is empty."""
    return F.regexp_extract(relpath, r"(?s)\A(.*/)?[^/]*\z", 1)


def _digests(files: DataFrame, digest: str) -> DataFrame:
    low, high = F.xxhash64("relpath", digest), F.xxhash64(digest, "relpath", F.lit("high"))
    return files.groupBy(F.regexp_replace(folder_of("relpath"), "/$", "").alias("folder")).agg(
        F.count("*").alias("files"), F.count_if(F.col(digest).isNull()).alias("unread"), F.bit_xor(low).alias("xor_low"),
        F.bit_xor(high).alias("xor_high"), F.sum(low.cast("decimal(38,0)")).alias("total"),
    )


def tree_digests(files: DataFrame, digest: str = "md5") -> DataFrame:
    """(folder, depth, digest parts) of every folder's whole sub-tree, the root's included.

    ``files`` has ``relpath`` and a digest. The tree is rolled up from one row a folder, not from the files again.
    """
    require_columns(files, ["relpath", digest], "tree_digests")
    names = F.when(F.col("folder") == "", F.array().cast("array<string>")).otherwise(F.split("folder", "/"))
    above = F.transform(F.sequence(F.lit(0), F.size("_names")), lambda n: F.struct(F.array_join(F.slice("_names", F.lit(1), n), "/").alias("folder"), n.alias("depth")))
    rolled = _digests(files, digest).withColumn("_names", names).select(F.explode(above).alias("_at"), *_PARTS)
    return rolled.groupBy("_at.folder", "_at.depth").agg(
        F.sum("files").alias("files"), F.sum("unread").alias("unread"), F.bit_xor("xor_low").alias("xor_low"), F.bit_xor("xor_high").alias("xor_high"),
        F.sum("total").alias("total"),
    )


def _agree() -> Column:
    same = F.lit(True)
    for part in _PARTS:
        same = same & (F.col(f"s.{part}") == F.col(f"t.{part}"))
    # What could not be read is never the same.
    return F.coalesce(same & (F.col("s.unread") == 0), F.lit(False))


def differing_trees(source: DataFrame, target: DataFrame, digest: str = "md5") -> DataFrame:
    """(folder, depth, files_source, files_target) of the sub-trees that differ, from the root down."""
    sides = tree_digests(source, digest).alias("s").join(tree_digests(target, digest).alias("t"), ["folder", "depth"], "full_outer")
    return sides.where(~_agree()).select("folder", "depth", F.col("s.files").alias("files_source"), F.col("t.files").alias("files_target"))


def audit_trees(source: DataFrame, target: DataFrame, digest: str = "md5") -> DataFrame:
    """The rows of ``verify`` for two listings with digests, each with a path at most once."""
    sides = _digests(source, digest).alias("s").join(_digests(target, digest).alias("t"), "folder", "full_outer")
    # Where nothing differs this is empty, and Spark joins no file with it.
    changed = sides.where(~_agree()).select(F.col("folder").alias("_folder"))
    below = F.regexp_replace(folder_of("relpath"), "/$", "") == F.col("_folder")
    same = source.join(changed, below, "left_anti").select(
        "relpath", F.col(digest).alias("md5_source"), F.col(digest).alias("md5_target"), F.lit("verified").alias("check")
    )
    compared = verify(source.join(changed, below, "left_semi"), target.join(changed, below, "left_semi"), digest=digest, unique=True)
    return same.unionByName(compared)
