"""Counts and summaries over a catalogue."""

import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from metaloom.operators.links import living


def source_rows(sources: DataFrame, datasets: DataFrame, services: DataFrame) -> DataFrame:
    """Every source with what is held from it, zeros included; most datasets first."""
    held = (datasets.select("context_id", F.lit(1).alias("d"), F.lit(0).alias("s"))
            .unionByName(services.select("context_id", F.lit(0).alias("d"), F.lit(1).alias("s")))
            .groupBy("context_id").agg(F.sum("d").alias("d"), F.sum("s").alias("s")))
    return (sources.join(held, "context_id", "left")
            .select("context_id", "status", "harvested", "title",
                    F.coalesce("d", F.lit(0)).alias("dataset_count"),
                    F.coalesce("s", F.lit(0)).alias("data_service_count"))
            .orderBy(F.desc("dataset_count"), F.desc("data_service_count"), "context_id"))


def source_summary(rows: DataFrame) -> DataFrame:
    """Sources in all, by outcome, and the failed ones that still hold records."""
    failed = F.col("status") == "failed"
    holding = failed & ((F.col("dataset_count") > 0) | (F.col("data_service_count") > 0))
    return rows.agg(F.count("*").alias("total"),
                    F.count_if(F.col("status") == "success").alias("succeeded"),
                    F.count_if(failed).alias("failed"),
                    F.count_if(holding).alias("failed_holding_records"))


def _sized(array):
    return F.greatest(F.coalesce(F.size(array), F.lit(0)), F.lit(0))


def catalogue_info(records: DataFrame, refreshed=None, now=None) -> DataFrame:
    """One row about unscoped records as read, in one pass: what is held, what the scope leaves
    out, what is stale and what nobody could check. Needs `publisher.id`. Where it is told when the copy was
    refreshed, also how many days ago that was (`now`: today)."""
    files = _sized(F.col("distributions"))
    alive = _sized(living(F.col("distributions")))
    gone = (files > 0) & (alive == 0)
    held, dataset = ~gone, F.col("type") != "data_service"
    unverified = _sized(F.filter(living(F.col("distributions")),
                                 lambda d: d["unverified"].isNotNull()))
    today = F.current_date() if now is None else F.lit(now).cast("date")
    age = [] if refreshed is None else [F.date_diff(today, F.lit(refreshed).cast("timestamp").cast("date")).cast("bigint").alias("age_days")]
    return records.agg(
        F.count_if(dataset & held).alias("datasets"),
        F.count_if(~dataset).alias("data_services"),
        F.count_distinct(F.when(held & (F.col("publisher.id") != ""),
                                F.col("publisher.id"))).alias("publishers"),
        F.coalesce(F.sum(files - alive), F.lit(0)).alias("dead_distributions"),
        F.count_if(gone).alias("dead_datasets"),
        F.count_if(dataset & held & F.col("stale").isNotNull()).alias("stale_datasets"),
        F.coalesce(F.sum(F.when(dataset, unverified)), F.lit(0)).alias("unverified_distributions")).select("*", *age)


def verdict_summary(verdicts: DataFrame) -> DataFrame:
    """Links checked, by outcome."""
    status = F.col("status")
    return verdicts.agg(
        F.count("*").alias("checked"), F.count_if(status == "alive").alias("alive"),
        F.count_if(status == "dead").alias("dead"),
        F.count_if(status == "unverified").alias("unverified"),
        F.count_if("invalid_cert").alias("invalid_cert"))


def run_summary(records: DataFrame) -> DataFrame:
    """What a build produced."""
    dataset = F.col("type") != "data_service"
    return records.agg(
        F.count_if(dataset).alias("datasets"), F.count_if(~dataset).alias("data_services"),
        F.coalesce(F.sum(_sized(F.col("distributions"))), F.lit(0)).alias("distributions"))


class Run:
    """What a build reads and how long it takes, measured on its way: metrics of the jobs it runs anyway."""

    def __init__(self, spark: SparkSession):
        self.spark, self.started, self.observed = spark, time.time(), []

    def reads(self, texts: DataFrame, column="text") -> DataFrame:
        """`texts` as they are; whatever writes them, or what is made of them, counts them once."""
        seen = Observation()
        self.observed.append(seen)
        return texts.observe(seen, F.count(F.lit(1)).alias("texts"), F.coalesce(F.sum(F.octet_length(column)), F.lit(0)).alias("bytes"))

    def summary(self, records: DataFrame) -> DataFrame:
        """`run_summary` with texts_read, bytes_read and the seconds since the run began."""
        seen = [o.get for o in self.observed]
        return run_summary(records).select(
            "*", F.lit(sum(s["texts"] for s in seen)).cast("bigint").alias("texts_read"),
            F.lit(sum(s["bytes"] for s in seen)).cast("bigint").alias("bytes_read"),
            F.lit(time.time() - self.started).alias("seconds"))


def duplicate_uris(records: DataFrame) -> DataFrame:
    """URIs on more than one entry."""
    return (records.filter(F.col("uri") != "").groupBy("uri").agg(F.count("*").alias("records"))
            .filter(F.col("records") > 1))
