"""Python work on files: how many tasks it gets, and how rows get there and back unchanged."""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType, TimestampType

BYTES_PER_TASK = 1024 * 1024 * 1024
FILES_PER_TASK = 2_000
# Files a task works on at once: a remote store answers slowly, and a core should not wait for it.
STREAMS_PER_TASK = 4
# More tasks than this in one stage burden the driver; each then gets more files.
MAX_TASKS = 100_000


# What a file costs besides its bytes: as many of them as fill a task.
FILE_COST = BYTES_PER_TASK // FILES_PER_TASK
# Hash groups of small files for each task.
_GROUPS_PER_TASK = 8


def _measure(files: DataFrame) -> tuple[int, int]:
    """Bytes and files. The table of names is small; the work behind it is not."""
    total = files.agg(F.sum("size").alias("bytes"), F.count("*").alias("files")).first()
    return total["bytes"] or 0, total["files"]


def _tasks_for(files: DataFrame, size: int, n: int) -> int:
    wanted = max(size // BYTES_PER_TASK, n // FILES_PER_TASK, files.sparkSession.sparkContext.defaultParallelism)
    return max(1, min(wanted, n, MAX_TASKS))


def task_count(files: DataFrame) -> int:
    """Enough tasks that each has a bounded number of bytes (by ``size``) and of files."""
    return _tasks_for(files, *_measure(files))


def spread(files: DataFrame, tasks: int | None = None) -> DataFrame:
    """Deal the files out by size, so that neither a folder nor a few large files make a slow task.

    A file of more than a quarter of a task's share is dealt by itself, and there are at most four such a task. The others
    are dealt in groups by a hash of their paths, eight a task. The driver has the sizes of both, a bounded number of them,
    and gives the largest first, each to the task with the least so far.
    """
    size, n = _measure(files)
    tasks = tasks or _tasks_for(files, size, n)
    if tasks == 1 or size + n * FILE_COST <= BYTES_PER_TASK:
        # All of it is one task's work at most: dealt one by one, no task's share is worth weighing.
        return files.repartition(tasks)
    weight = F.coalesce("size", F.lit(0)) + FILE_COST
    share = (size + n * FILE_COST) / tasks
    # Large ones have odd numbers, groups have even ones.
    alone = F.shiftleft(F.shiftrightunsigned(F.xxhash64("path"), 1), 1) + 1
    group = 2 * F.pmod(F.xxhash64("path"), F.lit(_GROUPS_PER_TASK * tasks))
    keyed = files.withColumn("_dealt", F.when(weight * 4 > share, alone).otherwise(group))
    loads = sorted(((r["weight"], r["_dealt"]) for r in keyed.groupBy("_dealt").agg(F.sum(weight).alias("weight")).collect()), reverse=True)
    least, given = [(0, task) for task in range(tasks)], []
    for load, key in loads:
        held, task = heapq.heappop(least)
        heapq.heappush(least, (held + load, task))
        given.append((key, task))
    keys, places = (pa.array(c, k) for c, k in zip(zip(*given), (pa.int64(), pa.int32())))
    table = files.sparkSession.createDataFrame(pa.table({"_dealt": keys, "_task": places}))
    # At most twelve rows a task.
    return keyed.join(F.broadcast(table), "_dealt").repartitionById(tasks, "_task").select(*files.columns)


# Times pass through Python as whole microseconds. As local times, which pandas
# would make of them, the hour that occurs twice a year could not be told apart.


def flat_schema(schema: StructType) -> StructType:
    return StructType(
        [StructField(f.name, LongType()) if isinstance(f.dataType, TimestampType) else f for f in schema.fields]
    )


def flatten_times(df: DataFrame) -> DataFrame:
    return df.select(*[F.unix_micros(f.name).alias(f.name) if isinstance(f.dataType, TimestampType) else f.name
                       for f in df.schema.fields])


def restore_times(df: DataFrame, schema: StructType) -> DataFrame:
    return df.select(*[F.timestamp_micros(f.name).alias(f.name) if isinstance(f.dataType, TimestampType) else f.name
                       for f in schema.fields])


def map_files(files: DataFrame, function, added: StructType, tasks: int | None = None) -> DataFrame:
    """Run a Python function over batches of files; it returns their rows with the added columns."""
    schema = StructType(files.schema.fields + added.fields)
    done = flatten_times(spread(files, tasks)).mapInPandas(function, flat_schema(schema))
    return restore_times(done, schema)
