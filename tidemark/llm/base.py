"""What the operators share: tables, written intermediate results, names that clash with nothing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import materialize, ship_package, small_batches


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the package on its executors, and with rows going to Python 2 MiB at a time from now on.

    A stage's rows are written by its caller, so the setting has to stay.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "2m")
    return ship_package(spark)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back; texts reach Python in small batches meanwhile."""
    with small_batches(df.sparkSession):
        return materialize(df, name)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def whole(text: str | Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def groups_for(rows: DataFrame, size: Column, limit: int) -> int:
    """How many groups of about ``limit`` the rows make, by the sum of ``size``; their number grows with the input."""
    total = rows.agg(F.sum(size)).first()[0] or 0
    return max(1, -(-int(total) // limit))
