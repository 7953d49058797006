"""Numbers over range partitions against a window over all rows."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusmill.operators.numbering import numbered


def test_numbers_equal_the_window_over_all_rows(spark):
    by = F.when(F.col("id") % 50 == 0, None).when(F.col("id") % 3 == 0, "rare").otherwise("hot")
    df = spark.range(3000).select(by.alias("by"), F.xxhash64("id").alias("o"), F.lit("kept").alias("n_other")).repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {(r.by, r.o): r.n for r in numbered(df, "by", "o").collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = {(r.by, r.o): r.n for r in df.withColumn("n", F.row_number().over(Window.partitionBy("by").orderBy("o"))).collect()}
    assert got == want and len(got) == 3000


def test_no_rows(spark):
    df = spark.createDataFrame([], "by string, o long")
    assert numbered(df, "by", "o").columns == ["by", "o", "n"] and numbered(df, "by", "o").count() == 0
