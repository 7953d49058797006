"""Numbers in order without a task that gets all rows of a value."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..work import written


def numbered(df: DataFrame, by: str, order: str, into: str = "n") -> DataFrame:
    """All columns and ``into``: 1, 2, 3, ... by ``order`` within each value of ``by``.

    Rows are sorted over range partitions; each value's rows are counted in each
    partition, and what earlier partitions hold of it is added to the number within
    the partition. Only those counts, one a value and partition, come together, so a
    value may hold any share of the rows. Nulls are a value; ``order`` orders rows
    wholly, else ties are numbered as they lie.
    """
    at = df.repartitionByRange(order).sortWithinPartitions(order).withColumn("__at", F.monotonically_increasing_id())
    rows = written(at, "ranges").withColumn("__part", F.shiftright("__at", 33))
    counts = rows.groupBy(F.col(by).alias("__by"), F.col("__part").alias("__of")).agg(F.count(F.lit(1)).alias("__k"))
    earlier = Window.partitionBy("__by").orderBy("__of").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("__by", "__of", F.coalesce(F.sum("__k").over(earlier), F.lit(0)).alias("__before"))
    own = rows.withColumn("__own", F.row_number().over(Window.partitionBy(by, "__part").orderBy("__at")))
    met = own.join(before, F.col(by).eqNullSafe(F.col("__by")) & (F.col("__part") == F.col("__of")))
    return met.select(*df.columns, (F.col("__before") + F.col("__own")).alias(into))
