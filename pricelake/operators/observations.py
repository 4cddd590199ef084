"""Price observations at their declared grain: one row per product and calendar day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.functions import dates
from pricelake.operators.dedup import keep_last
from pricelake.schemas import OBSERVATION_COLUMNS

GRAIN = ["product_id", "observed_date"]


def normalise_time(time: DataFrame) -> DataFrame:
    """Text, timestamp or date in full_date becomes a calendar day."""
    return time.withColumn("full_date", dates.day_of(F.col("full_date")))


def resolve_dates(facts: DataFrame, time: DataFrame) -> DataFrame:
    """Replace the source's time_id by the day it stands for; facts without one do not match.

    No hint: read from the lake, the day table is a few kilobytes of Parquet and Catalyst broadcasts
    it on its file size; were it ever large, the same plan falls back to a shuffled join.
    """
    days = time.select("time_id", F.col("full_date").alias("observed_date"))
    return facts.join(days, "time_id", "inner")


def orphan_facts(facts: DataFrame, time: DataFrame) -> DataFrame:
    """Facts whose time_id is unknown, for the quarantine."""
    orphans = facts.join(time.select("time_id"), "time_id", "left_anti").select(*facts.columns)
    return orphans.withColumn("_dq_reason", F.lit("orphan_time_id"))


def daily_observations(facts: DataFrame, time: DataFrame) -> DataFrame:
    """The fact with the highest id wins its product and day."""
    dated = resolve_dates(facts, time).select("fact_id", *OBSERVATION_COLUMNS)
    return keep_last(dated, GRAIN, ["fact_id"]).select(*OBSERVATION_COLUMNS)
