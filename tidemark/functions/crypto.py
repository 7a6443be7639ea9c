"""Digests and authenticated encryption with Spark's own functions."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.paths import ColumnOrName, _col

# Initialisation vector of 12 bytes before and a tag of 16 bytes after the cipher text.
GCM_OVERHEAD = 28


def content_md5(content: ColumnOrName) -> Column:
    """32 lower-case hex digits, zeros on the left kept."""
    return F.md5(_col(content))


def key_from_uri(spark: SparkSession, uri: str) -> Column:
    """The key bytes in a file, as a scalar subquery.

    The plan shows a subquery, never the key, so it does not reach logs. The
    file holds 16, 24 or 32 bytes.
    """
    return spark.read.format("binaryFile").load(uri).agg(F.max("content").alias("key")).scalar()


def encrypt(content: ColumnOrName, key: Column, bound_to: Column | None = None) -> Column:
    """AES-GCM with a fresh random vector; ``bound_to`` is authenticated along with it."""
    extra = F.lit("") if bound_to is None else bound_to
    return F.aes_encrypt(_col(content), key, F.lit("GCM"), F.lit("DEFAULT"), F.lit(b""), extra)


def decrypt(content: ColumnOrName, key: Column, bound_to: Column | None = None, strict: bool = False) -> Column:
    """Null when the tag does not fit, or an error when ``strict``."""
    extra = F.lit("") if bound_to is None else bound_to
    function = F.aes_decrypt if strict else F.try_aes_decrypt
    return function(_col(content), key, F.lit("GCM"), F.lit("DEFAULT"), extra)
