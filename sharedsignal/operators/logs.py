"""Task-log parsing and progress.

Logs are read with ``spark.read.text`` (one row per line, ``input_file_name``
as the task id); all parsing is regexp / arithmetic in the JVM.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.io import materialize

TIME_RE = r"Time taken: (\d+):(\d+):([0-9.]+)"
MEAN_INTERVAL = 1000


def read_logs(spark, pattern: str) -> DataFrame:
    """(log_id, line_no, line) from text files, one file one row set, so lines keep their order."""
    whole = spark.read.text(pattern, wholetext=True)
    return whole.select(F.input_file_name().alias("log_id"), F.posexplode(F.split("value", r"\r?\n")).alias("line_no", "line"))


def task_seconds(lines: DataFrame) -> DataFrame:
    """G1: seconds of the first 'Time taken: h:m:s' line per log, by ``line_no``.

    A line whose time can't be read is no such line.
    """
    def part(k):
        return F.regexp_extract("line", TIME_RE, k).try_cast("double")

    t = (lines.withColumn("seconds", part(3) + F.lit(60.0) * part(2) + F.lit(3600.0) * part(1))
              .filter(F.col("seconds").isNotNull()))
    return t.groupBy("log_id").agg(F.min_by("seconds", "line_no").alias("seconds"))


def error_lines(lines: DataFrame) -> DataFrame:
    """Lines containing ERROR, excluding 'no intersection'."""
    return lines.filter(F.col("line").rlike("ERROR") & ~F.col("line").rlike("no intersection"))


def running_mean(seconds: DataFrame, order_col: str = "log_id", interval: int = MEAN_INTERVAL) -> DataFrame:
    """Mean task time of the first ``interval``, 2 x ``interval``, ... logs in order.

    Only full intervals are reported.  The logs are numbered without one global sort
    task: range partitions are sorted and counted, and each gets the number of logs
    before it.  The running sum is over one row per interval.
    """
    n = int(seconds.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = seconds.repartitionByRange(n, order_col).withColumn("__part", F.spark_partition_id())
    inside = Window.partitionBy("__part").orderBy(order_col)
    # written: the bounds of the ranges are sampled, so dealing the rows a second time could give other parts
    numbered = materialize(dealt.withColumn("__rank", F.row_number().over(inside)), "numbered-logs")
    sizes = numbered.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = sizes.select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__before"))
    b = (numbered.join(before, "__part")
         .withColumn("bucket", F.floor((F.col("__before") + F.col("__rank") - 1) / interval))
         .groupBy("bucket").agg(F.sum("seconds").alias("s"), F.count(F.lit(1)).alias("n")))
    w = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    return (b.select("n", ((F.col("bucket") + 1) * interval).alias("iteration"), (F.sum("s").over(w) / F.sum("n").over(w)).alias("mean_seconds"))
             .filter(F.col("n") == interval).drop("n"))


def progress_counts(todo: DataFrame, done: DataFrame) -> DataFrame:
    """Finished vs outstanding tests."""
    return (todo.select(F.lit("outstanding").alias("state"))
                .unionByName(done.select(F.lit("finished").alias("state")))
                .groupBy("state").agg(F.count(F.lit(1)).alias("n_tests")))
