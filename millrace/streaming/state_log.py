"""The append-only event log of a run, as a batch table or a stream. An extension: the log itself is plain JSON lines."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "ts timestamp, event string, set_id int, argv array<string>, returncode int"


def append(events: DataFrame, path: str) -> None:
    """Adds events, stamped to the second where they have no time."""
    stamped = events.withColumn("ts", F.coalesce("ts", F.date_trunc("second", F.current_timestamp()))) if "ts" in events.columns else events.withColumn("ts", F.date_trunc("second", F.current_timestamp()))
    stamped.write.mode("append").json(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).json(path)


def stream(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(SCHEMA).json(path)


def latest(log: DataFrame) -> DataFrame:
    """The last event of every set."""
    return log.where("set_id is not null").groupBy("set_id").agg(F.max_by("event", "ts").alias("event"), F.max("ts").alias("ts"))


def event_counts(log: DataFrame, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events per window; a stream forgets windows that ended before the watermark."""
    return log.withWatermark("ts", late).groupBy(F.window("ts", window), "event").agg(F.count(F.lit(1)).alias("n"))


def pending(requested: DataFrame, log: DataFrame, done: str = "validated", after: int | None = None) -> DataFrame:
    """The requested sets beyond `after` that have no `done` event."""
    rest = requested.where(F.col("set_id") > after) if after is not None else requested
    return rest.join(log.where(F.col("event") == done).select("set_id").distinct(), "set_id", "left_anti")


def run_sets(spark: SparkSession, requested: DataFrame, path: str, steps: dict[str, Callable[[int], None]]) -> list[int]:
    """Runs the named steps for each requested set in turn, with an event after each; the last step's name marks it done.

    Sets that are done are left out, so a run that broke off goes on where it was. A step that fails is logged as
    `failed` and ends the run; nothing is deleted. Sets are numbered archives, a short list. Returns the sets that were run.
    """
    done = list(steps)[-1]

    def log(event: str, set_id: int, code: int) -> None:
        append(spark.createDataFrame([(event, set_id, [], code)], "event string, set_id int, argv array<string>, returncode int").coalesce(1), path)

    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    known = target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)
    rest = pending(requested, read(spark, path), done) if known else requested
    ran = sorted(r[0] for r in rest.select("set_id").distinct().collect())
    for set_id in ran:
        for name, step in steps.items():
            try:
                step(set_id)
            except Exception:
                log("failed", set_id, 1)
                raise
            log(name, set_id, 0)
    return ran
