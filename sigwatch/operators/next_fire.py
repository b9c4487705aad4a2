"""The greedy cooldown of a key of any size by pointer doubling.

With order and time given, the alert after an alert at row i is always the
first row of its key at or after time(i) + cooldown. This next-fire function
is computed for all rows at once, and composed with itself: after k rounds it
leads 2^k alerts on. The fired rows are those that the first row of a key
reaches; they double with every round, so a key with m alerts takes log2(m)
rounds of joins by row place, however many rows it has. No task folds a key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .small import written

ORDER = ("ts", "event_id")


def _same(key: list[str], other: str):
    out = F.lit(True)
    for k in key:
        out = out & F.col(k).eqNullSafe(F.col(other + k))
    return out


def placed(rows: DataFrame, key: list[str], order=ORDER, num_partitions: int | None = None) -> DataFrame:
    """The rows as a table with ``_place``: rising, with gaps, in the order of
    the key and ``order``. Range partitions cut a large key into many. Finding
    their bounds reads the rows once more, so they should be cheap to read."""
    n = num_partitions or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col(c) for c in (*key, *order)]
    return written(rows.repartitionByRange(n, *by).sortWithinPartitions(*by)
                   .withColumn("_place", F.monotonically_increasing_id()), "placed")


def next_at_or_after(places: DataFrame, key: list[str], gap_us: int, num_partitions: int | None = None) -> DataFrame:
    """(_place, _next): the first row of the key at or after ``_us`` + gap;
    rows without one are left out. ``places`` has key, ``_us`` and ``_place``.

    Rows and asked-for times are range-sorted together. Inside a partition the
    answer is the last row seen from the end; what a partition cannot answer
    takes the first row of the key's next partition that has one."""
    n = num_partitions or int(places.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = places.select(*key, F.col("_us").alias("_at"), "_place", F.lit(1).alias("_row"))
    asked = places.select(*key, (F.col("_us") + gap_us).alias("_at"), "_place", F.lit(0).alias("_row"))
    both = written(rows.unionByName(asked).repartitionByRange(n, *[F.col(k) for k in key], F.col("_at"))
                   .withColumn("_part", F.spark_partition_id()), "asked")
    place = F.when(F.col("_row") == 1, F.col("_place"))
    back = (Window.partitionBy(*key, "_part").orderBy(F.col("_at").desc(), F.col("_row").desc(), F.col("_place").desc())
            .rowsBetween(Window.unboundedPreceding, 0))
    here = both.withColumn("_here", F.last(place, ignorenulls=True).over(back)).where("_row = 0")
    # one row a key and partition
    firsts = both.groupBy(*key, "_part").agg(F.min(place).alias("_first"))
    behind = Window.partitionBy(*key).orderBy(F.col("_part").desc()).rowsBetween(Window.unboundedPreceding, -1)
    follow = firsts.withColumn("_after", F.last("_first", ignorenulls=True).over(behind)).select(
        *[F.col(k).alias("_f" + k) for k in key], F.col("_part").alias("_fpart"), "_after")
    found = here.join(follow, _same(key, "_f") & (F.col("_part") == F.col("_fpart")))
    return found.select("_place", F.coalesce("_here", "_after").alias("_next")).where("_next is not null")


def reached(first: DataFrame, follow: DataFrame) -> tuple[DataFrame, int]:
    """Places that the ``first`` places reach by following (_place, _next),
    themselves included, and the number of rounds. Paths must not meet again
    once they start apart (one path a key)."""
    # only the firsts and rows that some row leads to can lie on a path
    ends = follow.select(F.col("_next").alias("_place")).unionByName(first).distinct()
    follow = written(follow.join(ends, "_place", "left_semi"), "follow")
    marks, rounds = first, 0
    while not follow.isEmpty():
        rounds += 1
        # marks hold the first 2^k steps of every path, follow leads 2^k steps on
        marks = written(marks.unionByName(marks.join(follow, "_place").select(F.col("_next").alias("_place"))), "marks")
        far = follow.select(F.col("_place").alias("_next"), F.col("_next").alias("_far"))
        follow = written(follow.join(far, "_next").select("_place", F.col("_far").alias("_next")), "follow")
    return marks, rounds


def fired(rows: DataFrame, key: list[str], cooldown_sec: float, num_partitions: int | None = None) -> DataFrame:
    """The rows that fire: none of their key fired within the cooldown before
    them, in the order of ts and event_id. Rows without a ts always fire, and
    so do all rows without a cooldown."""
    gap = int(round(1e6 * cooldown_sec))
    if gap <= 0:
        return rows
    # sorted and joined are key and order alone; the rest of a row waits under its number
    numbered = written(rows.withColumn("_number", F.monotonically_increasing_id()), "numbered")
    table = placed(numbered.select(*key, *ORDER, "_number"), key, num_partitions=num_partitions)
    timed = table.where("ts is not null").select(*key, F.unix_micros("ts").alias("_us"), "_place")
    first = timed.groupBy(*key).agg(F.min("_place").alias("_place")).select("_place")
    marks, _ = reached(first, next_at_or_after(timed, key, gap, num_partitions))
    kept = table.where("ts is null").select("_place").unionByName(marks)
    kept = written(table.join(kept, "_place", "left_semi").select("_number"), "fired")
    return numbered.join(kept, "_number", "left_semi").select(*rows.columns)
