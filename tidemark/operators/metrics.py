"""Per-file gauges, counters and run totals over the ledger."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.fixed import METRIC_NAMES
from tidemark.functions.paths import leaf, metric_key, strip_leading_slash
from tidemark.functions.times import elapsed_ms, ms_to_s
from tidemark.operators.ledger import sent
from tidemark.schemas import require_columns
from tidemark.session import materialize

def retries() -> Column:
    return (F.col("attempts") - 1).cast("bigint")


def metrics_long(ledger: DataFrame, seen_ms: int | Column, with_key: bool = False) -> DataFrame:
    """Seven values for every file sent, one row each. Times are epoch seconds, durations ms."""
    seen = seen_ms if isinstance(seen_ms, Column) else F.lit(seen_ms)
    wide = sent(ledger).select(
        "pipeline",
        "run_id",
        F.col("fullfilename").alias("file"),
        F.col("mtime_s").cast("bigint").alias("created_on"),
        F.col("bytes").cast("bigint").alias("size_bytes"),
        ms_to_s(seen.cast("bigint")).alias("seen_on"),
        ms_to_s("end_ms").alias("transferred_on"),
        retries().alias("transfer_retries"),
        elapsed_ms("start_ms", "end_ms").alias("transfer_time"),
        F.lit(1).cast("bigint").alias("total_uploaded_files"),
    )
    long = wide.unpivot(["pipeline", "run_id", "file"], list(METRIC_NAMES), "metric", "value")
    return long.withColumn("key", metric_key("pipeline", "run_id", "file", "metric")) if with_key else long


def uploaded_files(ledger: DataFrame, by: list[str]) -> DataFrame:
    """How many files were sent, per pipeline, run or any other column."""
    return sent(ledger).groupBy(*by).agg(F.count("*").alias("total_uploaded_files"))


def run_totals(ledger: DataFrame, by: list[str]) -> DataFrame:
    """Files, bytes, retries and durations per group, with sub-totals and a grand total.

    The groups are reduced to their finest level once; the sub-totals are then
    made from that small table, not from the files again.
    """
    require_columns(ledger, [*by, "bytes", "attempts", "start_ms", "end_ms"], "run_totals")
    finest = ledger.groupBy(*by).agg(
        F.count("*").alias("files"),
        F.sum("bytes").alias("bytes"),
        F.sum(retries()).alias("retries"),
        F.max(retries()).alias("max_retries"),
        F.sum(elapsed_ms("start_ms", "end_ms")).alias("total_ms"),
        F.max(elapsed_ms("start_ms", "end_ms")).alias("max_ms"),
    )
    return finest.rollup(*by).agg(
        F.grouping_id().cast("int").alias("level"),
        F.sum("files").alias("files"),
        F.sum("bytes").alias("bytes"),
        F.sum("retries").alias("retries"),
        F.max("max_retries").alias("max_retries"),
        F.sum("total_ms").alias("total_ms"),
        F.max("max_ms").alias("max_ms"),
    )


def transfer_time_percentiles(ledger: DataFrame, by: list[str], at: list[float]) -> DataFrame:
    """Exact durations at the given ranks, in ms, between two values by interpolation.

    Equal durations are counted before the shuffle. The counts are sorted once over all groups and cut into ranges; sums
    of ranges tell in which one a rank lies, and only there are values looked at one by one. So a group with very many
    different durations is the work of as many tasks as it has ranges, and none reads more than its own.
    """
    counted = ledger.groupBy(*by, elapsed_ms("start_ms", "end_ms").alias("ms")).agg(F.count("*").alias("files"))
    return exact_percentiles(counted, by, "ms", "files", at).withColumnRenamed("found", "ms_at")


def exact_percentiles(counted: DataFrame, by: list[str], value: str, weight: str, at: list[float]) -> DataFrame:
    """(by, found): the values at ranks from 0 to 1 of each group's rows, where a row counts ``weight`` times.

    Null values do not count; a group without others has null. Groups may be null.
    """
    names = [f"_by{i}" for i in range(len(by))]
    rows = counted.select(*[F.col(b).alias(n) for b, n in zip(by, names)], F.col(value).alias("_value"), F.col(weight).alias("_n"))
    ranged = rows.where(F.col("_value").isNotNull()).repartitionByRange(*names, "_value") if names else (
        rows.where(F.col("_value").isNotNull()).repartitionByRange("_value")
    )
    # Which range a row fell into is settled once, by writing it down.
    ranged = materialize(ranged.withColumn("_range", F.spark_partition_id()), "ranges")
    sums = ranged.groupBy(*names, "_range").agg(F.sum("_n").alias("_here"))
    whole, earlier = Window.partitionBy(*names), Window.partitionBy(*names).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumns({"_before": F.coalesce(F.sum("_here").over(earlier), F.lit(0)), "_total": F.sum("_here").over(whole)})

    # Between two values a rank lies nearer to one of them.
    place = lambda p: (F.col("_total") - 1) * F.lit(float(p))
    ranks = [F.struct(F.lit(i).alias("i"), f(place(p)).cast("bigint").alias("rank")) for i, p in enumerate(at) for f in (F.floor, F.ceil)]
    wanted = sums.select("*", F.explode(F.array(*ranks)).alias("_wanted")).where(
        (F.col("_wanted.rank") >= F.col("_before")) & (F.col("_wanted.rank") < F.col("_before") + F.col("_here"))
    )
    wanted = wanted.groupBy(*[F.col(n).alias(f"{n}_") for n in names], F.col("_range").alias("_range_")).agg(
        F.max("_before").alias("_before"), F.max("_total").alias("_total"), F.collect_set("_wanted").alias("_wanted")
    )
    same = reduce(and_, [F.col(n).eqNullSafe(F.col(f"{n}_")) for n in names], F.col("_range") == F.col("_range_"))
    within = Window.partitionBy(*names, "_range").orderBy("_value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.col("_before") + F.sum("_n").over(within)
    placed = ranged.join(wanted, same).withColumn("_last", last)
    hits = placed.select(
        *names, "_total", "_value",
        F.explode(F.filter("_wanted", lambda w: (w["rank"] < F.col("_last")) & (w["rank"] >= F.col("_last") - F.col("_n")))).alias("_hit"),
    )

    def found(i: int, p: float) -> Column:
        of = lambda f: F.max(F.when((F.col("_hit.i") == i) & (F.col("_hit.rank") == f(place(p)).cast("bigint")), F.col("_value")))
        low, high, at_ = of(F.floor), of(F.ceil), F.max(place(p))
        return F.when(F.floor(at_) == F.ceil(at_), low.cast("double")).otherwise((F.ceil(at_) - at_) * low + (at_ - F.floor(at_)) * high)

    done = hits.groupBy(*names).agg(F.array(*[found(i, p) for i, p in enumerate(at)]).alias("found"))
    groups = rows.groupBy(*names).agg(F.lit(1).alias("_one")).drop("_one").select(*[F.col(n).alias(f"{n}_") for n in names])
    if not names:
        return done
    same = reduce(and_, [F.col(n).eqNullSafe(F.col(f"{n}_")) for n in names])
    return groups.join(done, same, "left").select(*[F.col(f"{n}_").alias(b) for n, b in zip(names, by)], "found")


def listing_summary(manifest: DataFrame, by: list[str]) -> DataFrame:
    """Files and bytes per group with the first and last name.

    The names themselves are the manifest's rows; see ``listing_messages``.
    """
    return manifest.groupBy(*by).agg(
        F.count("*").alias("files"),
        F.sum("size").alias("bytes"),
        F.min("filename").alias("first_name"),
        F.max("filename").alias("last_name"),
    )


def listing_messages(manifest: DataFrame) -> DataFrame:
    """The list of files to transfer, one row each, named as in a log line."""
    return manifest.select(
        strip_leading_slash("filename").alias("name"), leaf("filename").alias("leaf"), "size", "mtime_s"
    )
