"""Run logs, rejection details, rule results and the daily quality summary."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions import validation as v
from ledgerlake.functions.measures import percentage, seconds_between
from ledgerlake.operators.samples import samples
from ledgerlake.plans.staging import KEYS
from ledgerlake.schemas import TABLES
from ledgerlake.session import store_once


def run_status(error: Column, rejected: Column, stored: Column, received: Column) -> Column:
    return (
        F.when(error != "", "failed")
        .when(rejected > 0, "partial")
        .when(stored == received, "success")
        .otherwise("running")
    )


def with_run_measures(runs: DataFrame) -> DataFrame:
    """Score, status and duration of each run in an ingestion log."""
    c = F.col
    return (
        runs.withColumn("quality_score", percentage(c("records_stored"), c("records_received")))
        .withColumn(
            "status",
            run_status(
                c("error_message"),
                c("records_rejected"),
                c("records_stored"),
                c("records_received"),
            ),
        )
        .withColumn(
            "duration_seconds",
            seconds_between(c("extraction_started_at"), c("load_completed_at")),
        )
    )


def run_summary(log: DataFrame) -> DataFrame:
    """Counts and score per source, and of all sources together (source_name NULL)."""
    c = F.col
    return (
        log.rollup("source_name")
        .agg(
            F.sum("records_received").alias("received"),
            F.sum("records_stored").alias("stored"),
            F.sum("records_rejected").alias("rejected"),
            F.grouping("source_name").cast("boolean").alias("is_total"),
        )
        .withColumn("quality_score", percentage(c("stored"), c("received")))
    )


# ------------------------------------------------------------------------ rules


@dataclass(frozen=True)
class Rule:
    rule_id: int
    name: str
    description: str
    table: str
    column: str
    kind: str
    severity: str
    expression: str

    def broken(self, as_of: Column) -> Column:
        """Non-NULL where a row of the table breaks the rule."""
        c = F.col
        return {
            "product_price_positive": lambda: v.first_of(
                v.not_null(c("price"), "price"), v.positive(c("price"), "price")
            ),
            "product_title_not_null": lambda: v.not_null(c("title"), "title"),
            "customer_email_format": lambda: v.valid_email(c("email"), "email"),
            "sale_quantity_positive": lambda: v.first_of(
                v.not_null(c("quantity"), "quantity"), v.positive(c("quantity"), "quantity")
            ),
            "sale_date_not_future": lambda: v.not_future(c("sale_date"), "sale_date", as_of),
            "sale_total_matches": lambda: v.total_matches(
                c("quantity"), c("unit_price"), c("total_amount")
            ),
        }[self.name]()


# The default rules.
_P, _C, _S = "staging.products", "staging.customers", "staging.sales"
RULES = [
    Rule(1, "product_price_positive", "Product price must be greater than 0", _P, "price",
         "range", "error", "price > 0"),
    Rule(2, "product_title_not_null", "Product title cannot be null", _P, "title",
         "not_null", "error", "title IS NOT NULL"),
    Rule(3, "customer_email_format", "Customer email must be valid format", _C, "email",
         "format", "warning", "email LIKE '%_@_%.__%'"),
    Rule(4, "sale_quantity_positive", "Sale quantity must be greater than 0", _S, "quantity",
         "range", "error", "quantity > 0"),
    Rule(5, "sale_date_not_future", "Sale date cannot be in the future", _S, "sale_date",
         "range", "error", "sale_date <= current_date()"),
    Rule(6, "sale_total_matches", "Total amount should equal quantity * unit_price", _S,
         "total_amount", "expression", "warning", "abs(total_amount - quantity * unit_price) <= 0.01 * quantity * unit_price"),
]


def rule_catalogue(spark: SparkSession, now: Column) -> DataFrame:
    rows = [
        (r.rule_id, r.name, r.description, r.table, r.column, r.kind, r.expression, r.severity, True)
        for r in RULES
    ]
    declared = TABLES["quality.data_quality_rules"].partition(", created_at")[0]
    return spark.createDataFrame(rows, declared).withColumns({"created_at": now, "updated_at": now})


def rule_results(tables: dict[str, DataFrame], as_of: Column, folder: str | None = None) -> DataFrame:
    """Rows checked, passed and failed per rule, with a bounded sample of failing keys.

    All rules of a table are checked in one pass over it, which counts rows that pass together and
    those that fail by key; totals and samples both come from these counts. Tables are clean columns, of valid
    and invalid records alike; the errors of staging are not needed.
    """

    def results(table: str, rows: DataFrame) -> DataFrame:
        rules = [rule for rule in RULES if rule.table == table]
        key = F.col(KEYS[table.split(".")[1]][0]).cast("string")
        # Every rule is evaluated once per row; a row becomes one entry per rule.
        verdicts = [
            F.struct(
                F.lit(r.rule_id).alias("rule_id"),
                F.lit(r.name).alias("rule_name"),
                F.when(r.broken(as_of).isNotNull(), F.lit(True)).otherwise(F.lit(False)).alias("failed"),
            )
            for r in rules
        ]
        return rows.select(key.alias("_key"), F.inline(F.array(*verdicts)))

    def of_rules(table: str) -> DataFrame:
        rows = [(rule.rule_id, rule.name) for rule in RULES if rule.table == table]
        spark = tables[table].sparkSession
        return spark.createDataFrame(rows, "rule_id int, rule_name string")

    checked = reduce(DataFrame.unionByName, [results(name, rows) for name, rows in tables.items()])
    by_key = checked.groupBy("rule_id", "failed", F.when(F.col("failed"), F.col("_key")).alias("_key"))
    met = store_once(by_key.agg(F.count(F.lit(1)).alias("_n")), "rules", folder)
    counts = met.groupBy("rule_id").agg(
        F.sum("_n").alias("records_checked"), F.sum(F.when(F.col("failed"), F.col("_n")).otherwise(0)).alias("records_failed")
    )
    failing = samples(met.where("failed"), ["rule_id"], F.col("_key"), "sample_failures")
    every = reduce(DataFrame.unionByName, [of_rules(name) for name in tables])
    none = F.lit(0).cast("bigint")
    together = (
        every.join(counts, "rule_id", "left")
        .join(failing, "rule_id", "left")
        .select(
            "rule_id",
            "rule_name",
            F.coalesce("records_checked", none).alias("records_checked"),
            F.coalesce(F.col("records_checked") - F.col("records_failed"), none).alias("records_passed"),
            F.coalesce("records_failed", none).alias("records_failed"),
            F.coalesce("sample_failures", F.lit("[]")).alias("sample_failures"),
        )
    )
    return together.withColumn(
        "pass_rate", percentage(F.col("records_passed"), F.col("records_checked"))
    )


# ---------------------------------------------------------------- daily summary


def daily_summary(log: DataFrame, transforms: DataFrame, rules: DataFrame) -> DataFrame:
    """Runs, transformations and rule checks per day. A rule passes when no row fails it."""
    day = "summary_date"
    received, stored = F.sum("records_received"), F.sum("records_stored")
    ingested = log.groupBy(F.to_date("created_at").alias(day)).agg(
        F.count(F.lit(1)).alias("total_pipelines_run"),
        F.count_if(F.col("status") == "success").alias("successful_pipelines"),
        F.count_if(F.col("status") == "failed").alias("failed_pipelines"),
        received.alias("total_records_received"),
        stored.alias("total_records_stored"),
        F.sum("records_rejected").alias("total_records_rejected"),
        percentage(stored, received).alias("overall_quality_score"),
    )
    transformed = transforms.groupBy(F.to_date("created_at").alias(day)).agg(
        F.count(F.lit(1)).alias("total_transforms_run"),
        F.count_if(F.col("status") == "success").alias("successful_transforms"),
    )
    checked = rules.groupBy(F.to_date("executed_at").alias(day)).agg(
        F.count(F.lit(1)).alias("total_rules_executed"),
        F.count_if(F.col("records_failed") == 0).alias("rules_passed"),
        F.count_if(F.col("records_failed") > 0).alias("rules_failed"),
    )
    joined = ingested.join(transformed, day, "full_outer").join(checked, day, "full_outer")
    counts = [c for c in joined.columns if c not in (day, "overall_quality_score")]
    return joined.na.fill(0, counts)


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
