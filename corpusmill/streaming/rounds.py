"""Streams: saturation of rounds per topic, and the incremental source catalogue."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..dialect import SPARK
from ..functions import url as urls


def saturation_stream(rounds: DataFrame, threshold: float = 0.5, consecutive: int = 3) -> DataFrame:
    """``topic, round, rate, streak, saturated`` of streamed rounds.

    The state of a topic is one integer, its run of low rates. Rounds of a topic
    must arrive in order; those of one batch are put in order.
    """

    def step(key, batches, state: GroupState):
        rows = pd.concat(list(batches)).sort_values("round")
        streak = state.get[0] if state.exists else 0
        out = []
        for r in rows.itertuples():
            rate = (1.0 if r.new_count > 0 else 0.0) if r.prev_total == 0 else r.new_count / r.prev_total
            streak = streak + 1 if rate < threshold else 0
            out.append((key[0], r.round, rate, streak, streak >= consecutive))
        state.update((streak,))
        yield pd.DataFrame(out, columns=["topic", "round", "rate", "streak", "saturated"])

    return rounds.groupBy("topic").applyInPandasWithState(
        step, "topic string, round long, rate double, streak long, saturated boolean", "streak int", "append", GroupStateTimeout.NoTimeout
    )


def catalogue_stream(found: DataFrame, late: str = "7 days") -> DataFrame:
    """Sources whose canonical URL is new, with state bounded by a watermark on ``found_at``."""
    keyed = found.withColumn("canonical", F.expr(urls.canonical(SPARK)))
    return keyed.withWatermark("found_at", late).dropDuplicatesWithinWatermark(["canonical"])


def upsert_batches(spark: SparkSession, table_path: str):
    """A ``foreachBatch`` function: appends sources that the table does not hold.

    A batch that is run again after a failure adds nothing twice, as its rows
    are held against the table's by canonical URL.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        keyed = batch.withColumn("canonical", F.expr(urls.canonical(SPARK))).dropDuplicates(["canonical"])
        try:
            known = spark.read.parquet(table_path).select("canonical")
            keyed = keyed.join(known, "canonical", "left_anti")
        except Exception as error:  # the first batch finds no table
            if "PATH_NOT_FOUND" not in str(error):
                raise
        keyed.write.mode("append").parquet(table_path)

    return run
