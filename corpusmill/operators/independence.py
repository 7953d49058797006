"""Order-dependent independence of sources, as a fold in one pass over sorted rows.

A source is independent of those before it if its key wasn't taken and, unless it is an
academic article, neither was its domain; only independent ones take their key
and domain. So the answer depends on order, and no grouping by key alone gives it.
Rows are partitioned by card and sorted within; the fold walks Arrow batches and carries
the card's taken keys and domains from batch to batch. Its state is bounded by the
distinct groups of one card; a domain that holds most rows is one entry of it.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from ..dialect import SPARK
from ..functions import url as urls

#: Why a source is not independent; null where it is.
REASONS = ("no_key", "key", "domain")


class Fold:
    """The rule over one card's sources in order."""

    def __init__(self):
        self.card = self.keys = self.domains = None
        self.begun = False

    def reason(self, card, key: str | None, domain: str | None, academic: bool) -> str | None:
        if not self.begun or card != self.card:
            self.card, self.keys, self.domains, self.begun = card, set(), set(), True
        if not key:
            return "no_key"
        if key in self.keys:
            return "key"
        if domain and domain in self.domains and not academic:
            return "domain"
        self.keys.add(key)
        if domain:
            self.domains.add(domain)
        return None


def judged(sources: DataFrame, card: str = "card", order: tuple[str, ...] = ("ord",)) -> DataFrame:
    """All columns and ``independent, reason`` of each source (``url, original_source_id`` beside card and order).

    Sources without a key (no original id, no domain) are not independent. A null card
    is a card. Ties in the order are broken by URL and original id, nulls first.
    """
    own = ["__key", "__domain", "__academic"]
    s = sources.withColumn(own[0], F.expr(urls.source_key(SPARK))).withColumn(own[1], F.coalesce(F.expr(urls.host(SPARK)), F.lit("")))
    s = s.withColumn(own[2], F.coalesce(F.expr(urls.article_key(SPARK)).isNotNull(), F.lit(False)))
    ordered = s.repartition(card).sortWithinPartitions(card, *order, "url", "original_source_id")

    def run(batches):
        fold = Fold()
        for b in batches:
            found = [fold.reason(*r) for r in zip(b.column(card).to_pylist(), *[b.column(c).to_pylist() for c in own])]
            kept = b.drop_columns(own)
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array([r is None for r in found], pa.bool_()), pa.array(found, pa.string())], names=[*kept.schema.names, "independent", "reason"])

    return ordered.mapInArrow(run, StructType([*sources.schema.fields, StructField("independent", BooleanType()), StructField("reason", StringType())]))


def groups(sources: DataFrame, card: str = "card", order: tuple[str, ...] = ("ord",)) -> DataFrame:
    """``card, n_sources, groups, n_key, n_domain``: independent groups of each card, and what repeats them."""
    j = judged(sources, card, order)
    return j.groupBy(card).agg(
        F.count(F.lit(1)).alias("n_sources"), F.count_if("independent").alias("groups"), F.count_if(F.col("reason") == "key").alias("n_key"), F.count_if(F.col("reason") == "domain").alias("n_domain")
    )
