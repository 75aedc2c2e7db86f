"""Usage, cost, quota and budget reports.

The first aggregation runs over the whole log; everything after it works on one
row per warehouse and day, so windows and joins below are on small frames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom import labels
from tallyloom.functions.dates import day, days_before, month_of, months_before
from tallyloom.functions.numbers import bytes_as, dbl, rounded, safe_div, safe_pct
from tallyloom.sources.lab import ACCESS_AS_OF, EVENTS_AS_OF, Lab
from tallyloom.sources.shared import shared_path
from tallyloom.sources.tables import append_rows, insert_if_absent, literal_rows, union_padded, write_table

USD_PER_CREDIT = 3

# Warehouse configuration of the lab: warehouse, monthly quota, team, budget category
WAREHOUSES = [
    ("WH_VIEW", 20000, "Engineering", "COMPUTE_DEV"),
    ("WH_CLICK", 50000, "Operations", "COMPUTE_PROD"),
    ("WH_PURCHASE", 120000, "Analytics", "COMPUTE_ANALYTICS"),
    ("WH_SIGNUP", 150000, "Data Science", "COMPUTE_ML"),
    ("WH_ERROR", 500000, "Engineering", "COMPUTE_ETL"),
]
# Budget rows: category, monthly credits, alert threshold percent, owner
BUDGETS = [
    ("COMPUTE_DEV", 20000, 80, "engineering"), ("COMPUTE_PROD", 110000, 80, "operations"), ("COMPUTE_ANALYTICS", 120000, 80, "analytics"),
    ("COMPUTE_ML", 150000, 80, "science"), ("COMPUTE_ETL", 500000, 80, "engineering"), ("STORAGE", 5000000, 80, "engineering"),
    ("SERVERLESS", 2000, 80, "engineering"), ("AI", 300, 80, "science"),
]
# Monitor thresholds: warehouse, percent, action
TRIGGERS = [
    ("WH_VIEW", 75, "NOTIFY"), ("WH_VIEW", 90, "NOTIFY"), ("WH_VIEW", 100, "SUSPEND"),
    ("WH_CLICK", 50, "NOTIFY"), ("WH_CLICK", 75, "NOTIFY"), ("WH_CLICK", 90, "NOTIFY"), ("WH_CLICK", 100, "NOTIFY"),
    ("WH_PURCHASE", 50, "NOTIFY"), ("WH_PURCHASE", 75, "NOTIFY"), ("WH_PURCHASE", 90, "NOTIFY"), ("WH_PURCHASE", 100, "SUSPEND"),
    ("WH_SIGNUP", 50, "NOTIFY"), ("WH_SIGNUP", 75, "NOTIFY"), ("WH_SIGNUP", 90, "NOTIFY"), ("WH_SIGNUP", 95, "SUSPEND"),
    ("WH_ERROR", 75, "NOTIFY"), ("WH_ERROR", 90, "NOTIFY"), ("WH_ERROR", 100, "SUSPEND_IMMEDIATE"),
]


def _config(lab: Lab) -> DataFrame:
    return literal_rows(lab.spark, WAREHOUSES, "warehouse_name string, credit_quota int, team string, budget_category string")


def _elapsed() -> Column:
    return F.greatest(F.dayofmonth(day(EVENTS_AS_OF)), F.lit(1))


def _month_days() -> Column:
    return F.dayofmonth(F.last_day(day(EVENTS_AS_OF)))


def _this_month(lab: Lab) -> DataFrame:
    return lab.metering().filter((F.col("start_time") >= F.trunc(day(EVENTS_AS_OF), "month")) & F.col("warehouse_name").like("WH%"))


def running_usage(lab: Lab) -> DataFrame:
    """Daily credits and the month-to-date running total per warehouse."""
    daily = _this_month(lab).groupBy("warehouse_name", F.to_date("start_time").alias("usage_date")).agg(F.sum("credits_used").alias("daily_credits"))
    running = F.sum("daily_credits").over(Window.partitionBy("warehouse_name").orderBy("usage_date"))
    return daily.select("warehouse_name", "usage_date", dbl("daily_credits").alias("daily_credits"), dbl(running).alias("cumulative_credits"))


def usage_cost(lab: Lab) -> DataFrame:
    used = _this_month(lab).groupBy("warehouse_name").agg(F.sum("credits_used").alias("total_credits"), F.max("end_time").alias("last_usage"))
    return used.select("warehouse_name", dbl("total_credits").alias("total_credits"), dbl(F.col("total_credits") * USD_PER_CREDIT).alias("estimated_cost_usd"), "last_usage")


def _quota(lab: Lab) -> DataFrame:
    used = _this_month(lab).groupBy("warehouse_name").agg(F.sum("credits_used").alias("used"))
    return _config(lab).join(used, "warehouse_name", "left").withColumn("used_credits", dbl(F.coalesce("used", F.lit(0)))).drop("used")


def quota_status(lab: Lab) -> DataFrame:
    share = F.col("used_credits") / F.col("credit_quota")
    status = F.when(share >= 0.9, labels.QUOTA["critical"]).when(share >= 0.75, labels.QUOTA["warning"]).when(share >= 0.5, labels.QUOTA["on_track"]).otherwise(labels.QUOTA["healthy"])
    projected = rounded(F.col("used_credits") / _elapsed() * _month_days(), 0)
    return _quota(lab).select(
        "warehouse_name", "credit_quota", "used_credits", rounded(F.col("credit_quota") - F.col("used_credits"), 2).alias("remaining_credits"),
        rounded(share * 100, 2).alias("pct_used"), status.alias("status"), projected.alias("projected_monthly_credits"),
        F.when(projected > F.col("credit_quota"), labels.PROJECTION["over"]).otherwise(labels.PROJECTION["within"]).alias("projection_status"),
    )


def thresholds(lab: Lab) -> DataFrame:
    """The highest monitor threshold that month-to-date usage has crossed, and its action."""
    rules = literal_rows(lab.spark, TRIGGERS, "warehouse_name string, threshold int, action string")
    usage = _quota(lab).withColumn("pct_used", F.col("used_credits") / F.col("credit_quota") * 100)
    crossed = usage.join(rules, "warehouse_name", "left").groupBy("warehouse_name", "credit_quota", "pct_used").agg(
        F.max(F.when(F.col("pct_used") >= F.col("threshold"), F.struct("threshold", "action"))).alias("hit")
    )
    return crossed.select("warehouse_name", "credit_quota", rounded("pct_used", 2).alias("pct_used"), F.col("hit.threshold").alias("threshold"), F.coalesce("hit.action", F.lit("NONE")).alias("action"))


def _budget_dashboard(lab: Lab) -> DataFrame:
    """Budget rows against three usage sources: warehouses, storage and background work."""
    start = F.trunc(day(EVENTS_AS_OF), "month")
    compute = _this_month(lab).groupBy("warehouse_name").agg(F.sum("credits_used").alias("c")).join(_config(lab), "warehouse_name", "left").groupBy(
        F.coalesce("budget_category", F.lit("OTHER_COMPUTE")).alias("budget_category")
    ).agg(dbl(F.sum("c")).alias("credits_used"))
    avg = lambda c: safe_div(F.sum(c), F.count(c))
    storage = lab.storage_daily().filter(F.col("usage_date") >= start).agg(
        ((avg("storage_bytes") + avg("stage_bytes") + avg("failsafe_bytes")) / float(1024**4) * 23).alias("credits_used")
    ).withColumn("budget_category", F.lit("STORAGE"))
    background = lab.refresh_log().filter(F.col("refresh_start_time") >= start).agg((dbl(F.sum("rows_inserted")) / 1000).alias("credits_used")).withColumn("budget_category", F.lit("SERVERLESS"))
    budgets = literal_rows(lab.spark, BUDGETS, "budget_category string, monthly_budget_credits int, alert_threshold_pct int, owner string")
    used = F.coalesce("credits_used", F.lit(0.0))
    budget, pace = F.col("monthly_budget_credits"), used / _elapsed() * _month_days()
    status = F.when(used / budget >= 1.0, labels.BUDGET["over"]).when(used / budget >= F.col("alert_threshold_pct") / 100, labels.BUDGET["risk"]).when(pace > budget, labels.BUDGET["projected"]).otherwise(labels.BUDGET["fine"])
    return budgets.join(union_padded(compute, storage, background), "budget_category", "left").select(
        "budget_category", "monthly_budget_credits", (budget * USD_PER_CREDIT).alias("monthly_budget_usd"), rounded(used, 4).alias("mtd_credits_used"),
        rounded(used * USD_PER_CREDIT, 2).alias("mtd_cost_usd"), rounded(budget - used, 2).alias("remaining_credits"), rounded(used / budget * 100, 2).alias("pct_budget_used"),
        rounded(pace, 2).alias("projected_credits"), rounded(pace * USD_PER_CREDIT, 2).alias("projected_cost_usd"), status.alias("budget_status"), "owner",
    )


def budget_dashboard(lab: Lab) -> DataFrame:
    return _budget_dashboard(lab)


def budget_alerts(lab: Lab) -> DataFrame:
    """Alert rows for budgets at 75 % or more, or over."""
    hot = _budget_dashboard(lab).filter((F.col("pct_budget_used") >= 75) | F.col("budget_status").like("%OVER%"))
    message = F.concat(F.col("budget_category"), F.lit(" is at "), F.format_string("%.2f", "pct_budget_used"), F.lit("% of monthly budget. Status: "), F.col("budget_status"))
    return hot.select(day(EVENTS_AS_OF).alias("alert_date"), "budget_category", F.col("pct_budget_used").alias("pct_used"), F.col("budget_status").alias("status"), message.alias("alert_message"))


def alert_log(lab: Lab) -> DataFrame:
    """The log that alerts are appended to; an alert that it holds is not appended again."""
    alerts = budget_alerts(lab)
    path = shared_path(lab.spark, "alert-log")
    log = write_table(alerts.filter("status LIKE '%OVER%'"), path)
    for _ in range(2):
        log = append_rows(insert_if_absent(log, alerts, ["alert_date", "budget_category"]), path)
    return log


def spend_mom(lab: Lab) -> DataFrame:
    """Spend per week and category with change on the week before, over the log of one month."""
    return _spend(lab, lab.metering(), "week")


def spend_by_month(lab: Lab) -> DataFrame:
    """Spend per month and category with change on the month before, over the last year of the long log."""
    recent = F.col("start_time") >= F.trunc(months_before(ACCESS_AS_OF, 12), "month")
    return _spend(lab, lab.long_metering().filter(recent), "month")


def _spend(lab: Lab, log: DataFrame, period: str) -> DataFrame:
    spend = log.join(_config(lab).select("warehouse_name", F.col("budget_category").alias("category")), "warehouse_name", "left").groupBy(
        F.trunc(F.to_date("start_time"), period).alias("period"), F.coalesce("category", F.lit("OTHER_COMPUTE")).alias("category")
    ).agg(F.sum("credits_used").alias("credits_used"))
    previous = F.lag("credits_used").over(Window.partitionBy("category").orderBy("period"))
    out = spend.withColumn("previous", previous)
    return out.select(
        "period", "category", dbl("credits_used").alias("credits_used"), dbl(F.col("credits_used") * USD_PER_CREDIT).alias("estimated_cost_usd"),
        dbl("previous").alias("prev_credits"), safe_pct(F.col("credits_used") - F.col("previous"), F.col("previous")).alias("pct_change"),
    )


def anomaly_rows(daily: DataFrame, keys: list[str], at: str, value: str, before: Column) -> DataFrame:
    """Over-usage rows with a z-score against the key's own mean and sample deviation."""
    stats = daily.filter(before).groupBy(*keys).agg(safe_div(F.sum(value), F.count(value)).alias("avg_v"), F.stddev_samp(dbl(value)).alias("std_v"))
    z = (dbl(value) - F.col("avg_v")) / F.nullif(F.col("std_v"), F.lit(0.0))
    level = F.when(F.abs(z) > 3, labels.ANOMALY["extreme"]).when(F.abs(z) > 2, labels.ANOMALY["high"]).otherwise(labels.ANOMALY["normal"])
    return daily.join(stats, keys).filter(dbl(value) > F.col("avg_v") + F.col("std_v")).select(
        at, *keys, rounded(dbl(value), 2).alias(value), rounded("avg_v", 2).alias(f"avg_{value}"), rounded("std_v", 2).alias("stddev_credits"),
        rounded(z, 2).alias("z_score"), level.alias("anomaly_level"),
    )


def cost_anomaly(lab: Lab) -> DataFrame:
    recent = lab.metering().filter((F.col("start_time") >= days_before(EVENTS_AS_OF, 30)) & F.col("warehouse_name").like("WH%"))
    daily = recent.groupBy(F.to_date("start_time").alias("usage_date"), "warehouse_name").agg(F.sum("credits_used").alias("daily_credits"))
    return anomaly_rows(daily, ["warehouse_name"], "usage_date", "daily_credits", F.col("usage_date") < day(EVENTS_AS_OF))


def team_share(lab: Lab) -> DataFrame:
    teams = lab.metering().groupBy(month_of(F.to_date("start_time")).alias("month"), "warehouse_name").agg(F.sum("credits_used").alias("c")).join(
        _config(lab).select("warehouse_name", "team"), "warehouse_name"
    ).groupBy("month", "team").agg(F.sum("c").alias("total_credits"))
    whole = F.sum("total_credits").over(Window.partitionBy("month"))
    return teams.select("month", "team", dbl("total_credits").alias("total_credits"), dbl(F.col("total_credits") * USD_PER_CREDIT).alias("total_cost_usd"), safe_pct(F.col("total_credits"), whole).alias("pct_of_total"))


# -- storage and sharing -------------------------------------------------------


def storage_trend(lab: Lab) -> DataFrame:
    total = F.col("storage_bytes") + F.col("stage_bytes") + F.col("failsafe_bytes")
    return lab.storage_daily().filter(F.col("usage_date") >= days_before(EVENTS_AS_OF, 90)).select(
        "usage_date", bytes_as("storage_bytes", 4, 4).alias("storage_tb"), bytes_as("stage_bytes", 4, 4).alias("stage_tb"),
        bytes_as("failsafe_bytes", 4, 4).alias("failsafe_tb"), bytes_as(total, 4, 4).alias("total_tb"),
    )


def storage_by_database(lab: Lab) -> DataFrame:
    gb = lambda *cs: bytes_as(F.sum(sum((F.col(c) for c in cs[1:]), F.col(cs[0]))), 3, 2)
    return lab.table_storage().groupBy(F.col("table_catalog").alias("database_name")).agg(
        gb("active_bytes").alias("active_gb"), gb("time_travel_bytes").alias("time_travel_gb"), gb("failsafe_bytes").alias("failsafe_gb"),
        gb("active_bytes", "time_travel_bytes", "failsafe_bytes").alias("total_gb"),
    )


def largest_tables(lab: Lab) -> DataFrame:
    big = lab.table_storage().filter("active_bytes > 0").orderBy(F.desc("active_bytes"), "table_catalog", "table_name").limit(20)
    return big.select(
        F.col("table_catalog").alias("database_name"), "table_schema", "table_name", bytes_as("active_bytes", 3, 4).alias("active_gb"),
        bytes_as("time_travel_bytes", 3, 4).alias("time_travel_gb"), "row_count",
    )


def share_usage(lab: Lab) -> DataFrame:
    return lab.share_usage().filter(F.col("share_name").like("SHARE%"))


QUERIES = {f.__name__: f for f in [
    running_usage, usage_cost, quota_status, thresholds, budget_dashboard, budget_alerts, alert_log, spend_mom, spend_by_month, cost_anomaly, team_share,
    storage_trend, storage_by_database, largest_tables, share_usage,
]}
