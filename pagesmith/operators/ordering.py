"""Row numbers over a whole table without a single task: sorted ranges, counted and offset."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagesmith.session import scratch_path


def _free(df: DataFrame, base: str) -> str:
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def numbered(df: DataFrame, order: list, out: str = "row_no", ranges: int | None = None) -> DataFrame:
    """``df`` with the column ``out`` (long): 1, 2, 3... in the order given.

    The rows are dealt to ranges of the order, sorted there and written; a row's number is its place in its range plus
    the rows of the ranges before it, and only one number per range is broadcast.  Rows that tie in every term
    of the order are told apart by their place in the input, so a value that most rows share fills no single task;
    among them the numbers fall in any order.  An empty table gives an empty one.
    """
    spark = df.sparkSession
    place, part, first = _free(df, "place"), _free(df, "part"), _free(df, "first")
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tied = df.withColumn(place, F.monotonically_increasing_id())
    cut = tied.repartitionByRange(ranges, *order, F.col(place)).sortWithinPartitions(*order, place)
    # the low 33 bits of the generated id number the rows of a partition
    in_range = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    path = scratch_path(spark, "numbered")
    cut = cut.withColumn(part, F.spark_partition_id()).withColumn(place, in_range)
    cut.write.parquet(path)
    cut = spark.read.schema(cut.schema).parquet(path)
    offsets, total = [], 1
    for r in sorted(cut.groupBy(part).count().collect(), key=lambda r: r[part]):
        offsets.append((r[part], total))
        total += r["count"]
    before = spark.createDataFrame(offsets, f"`{part}` int, `{first}` long")
    return cut.join(F.broadcast(before), part).withColumn(out, F.col(first) + F.col(place)).drop(place, part, first)
