"""Customer, revenue, health and KPI data products.

Shared shape: aggregate each child table per customer first (map-side combined,
no fan-out), then join the one-row-per-customer frames. ``subscription_id``,
``user_id`` and ``ticket_id`` are keys of their tables, so a plain count is
their distinct count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom import labels
from tallyloom.functions.dates import day, day_diff, days_before, month_diff, month_of, months_before, year_diff
from tallyloom.functions.numbers import MONEY, count_when, dbl, mean, rounded, safe_div, safe_pct, sum_when
from tallyloom.operators.latest import latest_per_key
from tallyloom.operators.ordered import ordered_scan
from tallyloom.sources.lab import EVENTS_AS_OF, ORDERS_AS_OF, Lab
from tallyloom.sources.tables import row_counts, union_padded

OPEN = ["Open", "In Progress"]


# -- one-row-per-customer building blocks ---------------------------------


def active_revenue(lab: Lab) -> DataFrame:
    active = lab.subscriptions().filter("status = 'Active'")
    return active.groupBy("customer_id").agg(
        F.sum("mrr_amount").alias("total_mrr"),
        F.sum("arr_amount").alias("total_arr"),
        F.count("subscription_id").alias("product_count"),
        F.array_join(F.array_sort(F.collect_set("product_name")), ", ").alias("products_list"),
    )


def user_totals(lab: Lab) -> DataFrame:
    return lab.users().groupBy("customer_id").agg(
        F.count("user_id").alias("total_users"),
        count_when(F.col("user_status") == "Active").alias("active_users"),
        F.max("last_login_date").alias("last_login"),
    )


def latest_health(lab: Lab) -> DataFrame:
    return latest_per_key(lab.health_scores(), ["customer_id"], ["snapshot_date"])


def latest_nps(lab: Lab) -> DataFrame:
    slim = lab.feedback().select("customer_id", "submitted_date", "feedback_id", "nps_score", "nps_category")
    return latest_per_key(slim, ["customer_id"], ["submitted_date", "feedback_id"]).select(
        "customer_id", F.col("nps_score").alias("latest_nps_score"), "nps_category"
    )


def recent_tickets(lab: Lab, days: int = 90) -> DataFrame:
    recent = lab.tickets().filter(F.col("created_date") >= days_before(EVENTS_AS_OF, days))
    return recent.groupBy("customer_id").agg(F.count("*").alias("ticket_count"), mean("csat_score").alias("avg_csat"))


# -- segment ranking --------------------------------------------------------


def _customer_revenue(lab: Lab) -> DataFrame:
    totals = lab.subscriptions().groupBy("customer_id").agg(
        F.count("subscription_id").alias("product_count"),
        F.sum("mrr_amount").alias("total_mrr"),
        sum_when(F.col("status") == "Active", "mrr_amount").alias("active_mrr"),
        sum_when(F.col("status") == "Cancelled", "mrr_amount").alias("churned_mrr"),
    )
    return lab.customers(geo=True).join(totals, "customer_id", "left")


def segment_ranking(lab: Lab) -> DataFrame:
    """Rank, percentile and peer averages per segment, rolled up to segment x industry.

    A segment can hold a third of all customers, so ranks come from the
    distributed ordered scan: ascending position, which read backwards is the
    descending rank. Equal revenues share the percentile of their first position.
    """
    per = _customer_revenue(lab).select("customer_id", "segment", "industry", "health_score", "total_mrr")
    ranked = ordered_scan(
        per, ["segment"], [F.col("total_mrr").asc_nulls_last(), F.col("customer_id").desc()],
        row_number="position", group_rows="segment_customers",
    )
    cells = ranked.groupBy("segment", "industry", "total_mrr", "segment_customers").agg(
        F.count("*").alias("n"),
        F.sum("health_score").alias("health"),
        F.min("position").alias("first_position"),
        count_when(F.col("segment_customers") - F.col("position") + 1 <= 10).alias("top"),
    )
    ties = cells.groupBy(F.col("segment").alias("t_segment"), F.col("total_mrr").alias("t_mrr")).agg(F.min("first_position").alias("tie_position"))
    rated = cells.join(ties, F.col("segment").eqNullSafe(F.col("t_segment")) & F.col("total_mrr").eqNullSafe(F.col("t_mrr")))
    groups = rated.groupBy("segment", "industry", "segment_customers").agg(
        F.sum("n").alias("customer_count"),
        F.sum(F.col("total_mrr") * F.col("n")).cast(MONEY).alias("total_mrr"),
        F.sum("health").alias("health"),
        F.sum((F.col("tie_position") - 1) * F.col("n")).alias("below"),
        F.sum("top").alias("top_10_customers"),
        F.sum(F.when(F.col("total_mrr").isNotNull(), F.col("n")).otherwise(0)).alias("paying"),
    )
    peers = Window.partitionBy("segment")  # at most one row per industry here
    return groups.select(
        "segment", "industry", "customer_count", "total_mrr",
        rounded(safe_div(F.col("health"), F.col("customer_count")), 2).alias("avg_health"),
        rounded(F.coalesce(safe_div(F.col("below"), F.col("customer_count") * (F.col("segment_customers") - 1)), F.lit(0.0)), 4).alias("avg_percentile"),
        "top_10_customers",
        rounded(safe_div(F.sum("total_mrr").over(peers), F.sum("paying").over(peers)), 2).alias("segment_benchmark_mrr"),
    ).filter("customer_count > 5").withColumn("total_mrr", dbl("total_mrr"))


def ranked_customers(lab: Lab) -> DataFrame:
    """Every customer with rank, percentile, peer totals and both neighbours in its segment."""
    per = _customer_revenue(lab).select("customer_id", "segment", "total_mrr")
    ranked = ordered_scan(
        per, ["segment"], [F.col("total_mrr").desc_nulls_first(), F.col("customer_id").asc()],
        row_number="segment_rank", group_rows="segment_customer_count",
        lag={"prev_customer_mrr": "total_mrr"}, lead={"next_customer_mrr": "total_mrr"},
    )
    ties = ranked.groupBy(F.col("segment").alias("_segment"), F.col("total_mrr").alias("_mrr")).agg(F.max("segment_rank").alias("_last"))
    totals = per.groupBy("segment").agg(F.sum("total_mrr").alias("segment_total_mrr"), mean("total_mrr", 2).alias("segment_avg_mrr"))
    out = ranked.join(ties, F.col("segment").eqNullSafe(F.col("_segment")) & F.col("total_mrr").eqNullSafe(F.col("_mrr"))).join(totals, "segment")
    return out.select(
        "customer_id", "segment", dbl("total_mrr").alias("total_mrr"), "segment_rank",
        rounded(safe_div(F.col("segment_customer_count") - F.col("_last"), F.col("segment_customer_count") - 1), 6).alias("mrr_percentile"),
        "segment_avg_mrr", dbl("segment_total_mrr").alias("segment_total_mrr"), "segment_customer_count",
        dbl("prev_customer_mrr").alias("prev_customer_mrr"), dbl("next_customer_mrr").alias("next_customer_mrr"),
    )


def segment_matrix(lab: Lab) -> DataFrame:
    """Each segment x industry total against those of every other segment.

    The rollup rows (category combinations, not data rows) are replicated per
    other segment and equi-joined on it, so no nested-loop join is planned.
    """
    rollup = _customer_revenue(lab).groupBy("segment", "industry").agg(F.sum("total_mrr").cast(MONEY).alias("mrr"))
    names = rollup.agg(F.array_sort(F.collect_set("segment"))).scalar()
    a = rollup.withColumn("segment_b", F.explode(F.array_except(names, F.array("segment"))))
    b = rollup.select(F.col("segment").alias("segment_b"), F.col("industry").alias("industry_b"), F.col("mrr").alias("mrr_b"))
    return a.join(b, "segment_b").select(
        F.col("segment").alias("segment_a"), "segment_b", F.col("industry").alias("industry_a"), "industry_b",
        dbl("mrr").alias("mrr_a"), dbl("mrr_b").alias("mrr_b"), dbl(F.col("mrr") - F.col("mrr_b")).alias("mrr_diff"),
    )


def segment_summary(lab: Lab) -> DataFrame:
    return _customer_revenue(lab).groupBy("segment", "industry").agg(
        F.count("customer_id").alias("customers"),
        dbl(F.sum("total_mrr")).alias("mrr"),
        mean("health_score").alias("avg_health"),
        mean(F.coalesce("product_count", F.lit(0))).alias("avg_products"),
        safe_pct(F.sum("churned_mrr"), F.sum("total_mrr")).alias("churn_rate"),
    )


# -- simple revenue -----------------------------------------------------------


def revenue_by_segment(lab: Lab) -> DataFrame:
    return lab.customers().groupBy("segment").agg(F.count("*").alias("customers"), dbl(F.sum("mrr")).alias("total_mrr"))


def active_products(lab: Lab) -> DataFrame:
    joined = lab.customers().join(active_revenue(lab).drop("products_list"), "customer_id")
    return joined.groupBy("company_name", "segment").agg(
        F.sum("product_count").alias("products"), dbl(F.sum("total_mrr")).alias("total_mrr")
    )


def customer_listing(lab: Lab) -> DataFrame:
    """Star-plus projection of the customer table with a computed yearly value."""
    return lab.customers().select("*", (F.col("mrr") * 12).cast(MONEY).alias("arr")).withColumns({"mrr": dbl("mrr"), "arr": dbl("arr")})


def cohort_revenue(lab: Lab) -> DataFrame:
    s = lab.subscriptions().select("subscription_id", "customer_id", "product_name", "plan_tier", "mrr_amount", "arr_amount", "status", month_of("start_date").alias("cohort_month"))
    c = lab.customers(geo=True).select("customer_id", "segment", "industry")
    return s.join(c, "customer_id").groupBy("cohort_month", "segment", "industry", "product_name", "plan_tier").agg(
        F.count("subscription_id").alias("subscription_count"),
        dbl(F.sum("mrr_amount")).alias("total_mrr"),
        dbl(F.sum("arr_amount")).alias("total_arr"),
        mean("mrr_amount").alias("avg_mrr"),
        count_when(F.col("status") == "Cancelled").alias("churned_subscriptions"),
    )


def _revenue_by_month(lab: Lab, since: Column | None = None) -> DataFrame:
    s = lab.subscriptions(since=since).select("subscription_id", "customer_id", "product_name", "plan_tier", "mrr_amount", "arr_amount", "status", month_of("start_date").alias("revenue_month"))
    c = lab.customers(geo=True).select("customer_id", "segment", "industry")
    return s.join(c, "customer_id").groupBy("revenue_month", "segment", "industry", "product_name", "plan_tier").agg(
        F.count("subscription_id").alias("subscription_count"),
        F.count_distinct("customer_id").alias("customer_count"),
        F.sum("mrr_amount").alias("total_mrr"),
        F.sum("arr_amount").alias("total_arr"),
        mean("mrr_amount").alias("avg_mrr"),
        sum_when(F.col("status") == "Active", "mrr_amount").alias("active_mrr"),
        sum_when(F.col("status") == "Cancelled", "mrr_amount").alias("churned_mrr"),
        safe_pct(count_when(F.col("status") == "Cancelled"), F.count("*")).alias("churn_rate_pct"),
    )


def revenue_churn(lab: Lab) -> DataFrame:
    return _revenue_by_month(lab).withColumns({c: dbl(c) for c in ["total_mrr", "total_arr", "active_mrr", "churned_mrr"]})


def revenue_six_months(lab: Lab) -> DataFrame:
    recent = _revenue_by_month(lab, since=months_before(ORDERS_AS_OF, 6)).filter(F.col("revenue_month") >= months_before(ORDERS_AS_OF, 6))
    return recent.groupBy("segment", "product_name").agg(
        dbl(F.sum("total_mrr")).alias("total_mrr"), F.sum("customer_count").alias("customers")
    )


# -- customer 360 --------------------------------------------------------------


def customer_360_faithful(lab: Lab) -> DataFrame:
    """The four-way fan-out form: revenue sums repeat per user and per ticket.

    Joining before summing multiplies each subscription by the customer's user
    rows and ticket rows. The same totals are obtained here from the per-customer
    counts, so no multiplied row is ever produced.
    """
    health = lab.health_scores()
    newest = health.filter(F.col("snapshot_date") == health.agg(F.max("snapshot_date")).scalar()).select("customer_id", "overall_health_score", "churn_risk")
    tickets = recent_tickets(lab).select("customer_id", "ticket_count")
    joined = lab.customers(geo=True).join(active_revenue(lab).drop("products_list"), "customer_id", "left").join(user_totals(lab), "customer_id", "left").join(newest, "customer_id", "left").join(tickets, "customer_id", "left")
    copies = F.greatest(F.coalesce("total_users", F.lit(0)), F.lit(1)) * F.greatest(F.coalesce("ticket_count", F.lit(0)), F.lit(1))
    return joined.select(
        "customer_id", "company_name", "segment", "industry", "state", "account_status", "csm_owner",
        F.col("created_date").alias("customer_since"),
        month_diff(F.col("created_date"), day(ORDERS_AS_OF)).alias("tenure_months"),
        F.coalesce("product_count", F.lit(0)).alias("active_subscriptions"),
        dbl(F.coalesce(F.col("total_mrr") * copies, F.lit(0))).alias("total_mrr"),
        dbl(F.coalesce(F.col("total_arr") * copies, F.lit(0))).alias("total_arr"),
        F.coalesce("total_users", F.lit(0)).alias("total_users"),
        F.coalesce("active_users", F.lit(0)).alias("active_users"),
        F.col("last_login").alias("last_user_login"), "overall_health_score", "churn_risk",
        F.coalesce("ticket_count", F.lit(0)).alias("total_tickets_90d"),
    )


def _customer_360(lab: Lab) -> DataFrame:
    status = (
        F.when(F.col("account_status") == "Churned", labels.PROFILE["churned"])
        .when(F.col("churn_risk") == "Critical", labels.PROFILE["risk"])
        .when(F.col("overall_health_score") >= 80, labels.PROFILE["healthy"])
        .when(F.col("overall_health_score") >= 60, labels.PROFILE["attention"])
        .otherwise(labels.PROFILE["risk"])
    )
    joined = (
        lab.customers(geo=True)
        .join(active_revenue(lab), "customer_id", "left")
        .join(user_totals(lab), "customer_id", "left")
        .join(latest_health(lab).select("customer_id", "overall_health_score", "churn_risk", "health_trend"), "customer_id", "left")
        .join(recent_tickets(lab), "customer_id", "left")
        .join(latest_nps(lab), "customer_id", "left")
    )
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return joined.select(
        "customer_id", "company_name", "segment", "industry", "state", "account_status", "csm_owner",
        F.col("created_date").alias("customer_since"),
        month_diff(F.col("created_date"), day(ORDERS_AS_OF)).alias("tenure_months"),
        zero("total_mrr"), zero("total_arr"),
        F.coalesce("product_count", F.lit(0)).alias("active_products"), "products_list",
        zero("total_users"), zero("active_users"), "last_login",
        day_diff(F.col("last_login"), day(ORDERS_AS_OF)).alias("days_since_last_login"),
        "overall_health_score", "churn_risk", "health_trend",
        F.coalesce("ticket_count", F.lit(0)).alias("tickets_90d"), "avg_csat",
        "latest_nps_score", "nps_category", status.alias("customer_health_status"),
    )


def customer_360(lab: Lab) -> DataFrame:
    return _customer_360(lab).withColumns({"total_mrr": dbl("total_mrr"), "total_arr": dbl("total_arr")})


def executive_kpis(lab: Lab) -> DataFrame:
    status, risk, nps = F.col("account_status"), F.col("churn_risk"), F.col("nps_category")
    return _customer_360(lab).filter("account_status <> 'Trial'").agg(
        F.count("*").alias("total_customers"),
        count_when(status == "Active").alias("active_customers"),
        count_when(status == "Churned").alias("churned_customers"),
        safe_pct(count_when(status == "Churned"), F.count("*")).alias("churn_rate_pct"),
        dbl(F.sum("total_mrr")).alias("total_mrr"),
        dbl(F.sum("total_arr")).alias("total_arr"),
        mean("total_mrr", 2).alias("avg_mrr_per_customer"),
        count_when(F.col("segment") == "BUILDING").alias("building_customers"),
        count_when(F.col("segment") == "MACHINERY").alias("machinery_customers"),
        count_when(F.col("segment") == "HOUSEHOLD").alias("household_customers"),
        mean("overall_health_score").alias("avg_health_score"),
        count_when(risk == "Critical").alias("critical_risk_customers"),
        count_when(risk == "High").alias("high_risk_customers"),
        mean("active_users").alias("avg_active_users"),
        mean("days_since_last_login").alias("avg_days_since_login"),
        mean("latest_nps_score").alias("avg_nps_score"),
        count_when(nps == "Promoter").alias("promoter_count"),
        count_when(nps == "Detractor").alias("detractor_count"),
    ).withColumn("report_date", day(ORDERS_AS_OF))


def _health_dashboard(lab: Lab) -> DataFrame:
    used = lab.usage_daily().groupBy("customer_id").agg(
        F.sum(F.when(F.col("usage_date") >= days_before(EVENTS_AS_OF, 7), F.col("total_logins")).otherwise(0)).alias("last_7d_logins"),
        F.sum(F.when(F.col("usage_date") >= days_before(EVENTS_AS_OF, 30), F.col("emails_sent")).otherwise(0)).alias("last_30d_emails"),
    )
    support = lab.tickets().groupBy("customer_id").agg(
        count_when(F.col("status").isin(OPEN)).alias("open_tickets"),
        mean(F.when(F.col("created_date") >= days_before(EVENTS_AS_OF, 30), F.col("csat_score"))).alias("avg_recent_csat"),
    )
    revenue = active_revenue(lab).select("customer_id", "total_mrr")
    at_risk = latest_health(lab).filter(F.col("churn_risk").isin("Critical", "High", "Medium"))
    critical = F.col("churn_risk") == "Critical"
    action = (
        F.when(critical & (F.col("total_mrr") > 500), labels.ACTION["executive"])
        .when(critical, labels.ACTION["call"])
        .when((F.col("churn_risk") == "High") & (F.col("health_trend") == "Declining"), labels.ACTION["check_in"])
        .when(F.col("usage_score") < 40, labels.ACTION["training"])
        .when(F.col("last_7d_logins") == 0, labels.ACTION["re_engage"])
        .when(F.col("open_tickets") > 3, labels.ACTION["tickets"])
        .otherwise(labels.ACTION["none"])
    )
    joined = (
        lab.customers(geo=True).filter("account_status = 'Active'")
        .join(at_risk, "customer_id").join(revenue, "customer_id", "left")
        .join(used, "customer_id", "left").join(support, "customer_id", "left")
    )
    return joined.select(
        "customer_id", "company_name", "segment", "industry", "csm_owner", "account_status",
        "overall_health_score", "usage_score", "engagement_score", "support_score", "payment_score",
        "churn_risk", "health_trend", F.col("snapshot_date").alias("health_score_date"),
        F.coalesce("total_mrr", F.lit(0)).alias("mrr_at_risk"),
        F.coalesce("last_7d_logins", F.lit(0)).alias("logins_last_7d"),
        F.coalesce("last_30d_emails", F.lit(0)).alias("emails_last_30d"),
        F.coalesce("open_tickets", F.lit(0)).alias("open_tickets"),
        F.coalesce("avg_recent_csat", F.lit(0.0)).alias("recent_csat"),
        action.alias("recommended_action"),
    )


def health_dashboard(lab: Lab) -> DataFrame:
    return _health_dashboard(lab).withColumn("mrr_at_risk", dbl("mrr_at_risk"))


def top_at_risk(lab: Lab) -> DataFrame:
    return health_dashboard(lab).orderBy(F.desc("mrr_at_risk"), "customer_id").limit(10).select(
        "customer_id", "company_name", "segment", "csm_owner", "overall_health_score", "churn_risk", "mrr_at_risk", "recommended_action"
    )


# -- shared extracts ---------------------------------------------------------


def _shared_customer_summary(lab: Lab) -> DataFrame:
    shared = lab.customers(geo=True).filter(F.col("account_status").isin("Active", "Paused"))
    revenue = active_revenue(lab).select("customer_id", "total_mrr", "product_count")
    health = latest_health(lab).select("customer_id", "overall_health_score", "churn_risk")
    return shared.join(revenue, "customer_id", "left").join(health, "customer_id", "left").select(
        "customer_id", "company_name", "segment", "industry", "state", "account_status",
        month_diff(F.col("created_date"), day(ORDERS_AS_OF)).alias("tenure_months"),
        F.coalesce("total_mrr", F.lit(0).cast(MONEY)).alias("mrr"),
        F.coalesce("product_count", F.lit(0)).alias("products"), "overall_health_score", "churn_risk",
    )


def shared_customer_summary(lab: Lab) -> DataFrame:
    return _shared_customer_summary(lab).withColumn("mrr", dbl("mrr"))


def executive_metrics(lab: Lab) -> DataFrame:
    return _shared_customer_summary(lab).agg(
        F.count("customer_id").alias("total_customers"), dbl(F.sum("mrr")).alias("total_mrr"), mean("mrr", 2).alias("avg_mrr"),
        mean("overall_health_score").alias("avg_health_score"),
        count_when(F.col("churn_risk") == "Critical").alias("critical_risk_count"),
    ).withColumn("report_date", day(ORDERS_AS_OF))


def product_usage_month(lab: Lab) -> DataFrame:
    return lab.usage_daily().groupBy(month_of("usage_date").alias("usage_month")).agg(
        F.count_distinct("customer_id").alias("active_customers"), F.sum("emails_sent").alias("total_emails"),
        F.sum("social_posts").alias("total_social_posts"), F.sum("messages_sent").alias("total_texts"),
        mean("session_minutes").alias("avg_session_minutes"),
    )


# -- analytics bases -----------------------------------------------------------


def _customer_base(lab: Lab) -> DataFrame:
    return lab.customers(geo=True).join(latest_health(lab), "customer_id", "left").select(
        "customer_id", F.col("company_name").alias("customer_name"), F.col("segment").alias("customer_segment"), "industry", "state",
        "account_status", F.col("csm_owner").alias("customer_success_manager"), F.col("created_date").alias("customer_since_date"),
        month_diff(F.col("created_date"), day(ORDERS_AS_OF)).alias("customer_tenure_months"),
        year_diff(F.col("created_date"), day(ORDERS_AS_OF)).alias("customer_tenure_years"),
        "overall_health_score", "usage_score", "engagement_score", "support_score", "payment_score", "churn_risk", "health_trend",
        F.col("snapshot_date").alias("health_score_date"),
    )


def _names(lab: Lab) -> DataFrame:
    return lab.customers(geo=True).select("customer_id", F.col("company_name").alias("customer_name"), F.col("segment").alias("customer_segment"), "industry")


def _revenue_base(lab: Lab) -> DataFrame:
    kept = 100 - F.coalesce("discount_percent", F.lit(0))
    return lab.subscriptions().join(_names(lab), "customer_id").select(
        "subscription_id", "customer_id", "customer_name", "customer_segment", "industry", "product_name", "plan_tier",
        F.col("status").alias("subscription_status"), F.col("start_date").alias("subscription_start_date"),
        F.col("end_date").alias("subscription_end_date"),
        month_of("start_date").alias("cohort_month"), F.trunc("start_date", "quarter").alias("cohort_quarter"), F.trunc("start_date", "year").alias("cohort_year"),
        F.col("mrr_amount").alias("monthly_recurring_revenue"), F.col("arr_amount").alias("annual_recurring_revenue"), "discount_percent",
        (dbl(F.col("mrr_amount") * kept) / 100).alias("net_mrr"),
    )


def _usage_base(lab: Lab) -> DataFrame:
    rate = lambda a, b: F.when(F.col(b) > 0, rounded(dbl(a) * 100.0 / dbl(b), 4)).otherwise(F.lit(0.0))
    return lab.usage_daily().join(_names(lab), "customer_id").select(
        "usage_date", F.trunc("usage_date", "week").alias("usage_week"), month_of("usage_date").alias("usage_month"),
        F.trunc("usage_date", "quarter").alias("usage_quarter"), F.dayname("usage_date").alias("day_of_week"),
        "customer_id", "customer_name", "customer_segment", "industry", "user_id", "emails_sent", "emails_opened", "emails_clicked",
        rate("emails_opened", "emails_sent").alias("email_open_rate"), rate("emails_clicked", "emails_opened").alias("email_click_rate"),
        "social_posts", "messages_sent", (F.col("messages_sent") + F.col("emails_opened")).alias("total_messages"), "total_logins", "session_minutes",
    )


def _support_base(lab: Lab) -> DataFrame:
    created = F.to_date("created_date")
    return lab.tickets().join(_names(lab).drop("industry"), "customer_id").select(
        "ticket_id", "customer_id", "customer_name", "customer_segment", F.col("category").alias("ticket_category"),
        F.col("priority").alias("ticket_priority"), F.col("status").alias("ticket_status"), F.col("created_date").alias("ticket_created_date"),
        F.trunc(created, "month").alias("ticket_month"), F.trunc(created, "week").alias("ticket_week"), "resolution_time_hours",
        F.col("csat_score").alias("customer_satisfaction_score"), "sla_met",
        F.when(F.col("status").isin("Resolved", "Closed"), 1).otherwise(0).alias("is_resolved"),
        F.when(F.col("priority").isin("High", "Urgent"), 1).otherwise(0).alias("is_high_priority"),
    )


def analytics_base_customer(lab: Lab) -> DataFrame:
    return _customer_base(lab)


def analytics_base_revenue(lab: Lab) -> DataFrame:
    return _revenue_base(lab).withColumns({c: dbl(c) for c in ["monthly_recurring_revenue", "annual_recurring_revenue"]})


def analytics_base_usage(lab: Lab) -> DataFrame:
    return _usage_base(lab).withColumn("session_minutes", dbl("session_minutes"))


def analytics_base_support(lab: Lab) -> DataFrame:
    return _support_base(lab)


# -- histories, contribution, dashboard ------------------------------------------


def _mrr_history(lab: Lab) -> DataFrame:
    recent = lab.subscriptions(since=months_before(ORDERS_AS_OF, 24)).filter(F.col("status") == "Active")
    return recent.groupBy(month_of("start_date").alias("month")).agg(
        F.sum("mrr_amount").alias("total_mrr"), F.count_distinct("customer_id").alias("customer_count")
    )


def mrr_history(lab: Lab) -> DataFrame:
    return _mrr_history(lab).select("month", dbl("total_mrr").alias("total_mrr"), "customer_count", rounded(safe_div(F.col("total_mrr"), F.col("customer_count")), 2).alias("arpu"))


def daily_usage(lab: Lab) -> DataFrame:
    recent = lab.usage_daily().filter(F.col("usage_date") >= days_before(EVENTS_AS_OF, 90))
    return recent.groupBy("usage_date").agg(
        F.count_distinct("customer_id").alias("active_customers"), F.sum("emails_sent").alias("total_emails"),
        F.sum("total_logins").alias("total_logins"), mean("session_minutes").alias("avg_session_minutes"),
    )


def mrr_change(lab: Lab) -> DataFrame:
    """Contribution of segment, industry and product to the change of active revenue.

    Both periods are running totals of the same table, so one scan with two
    conditional sums replaces two aggregates and a full join.
    """
    active = lab.subscriptions().filter((F.col("status") == "Active") & (F.col("start_date") <= day(ORDERS_AS_OF)))
    per = active.groupBy("customer_id", "product_name").agg(
        F.sum("mrr_amount").alias("current_mrr"),
        sum_when(F.col("start_date") <= months_before(ORDERS_AS_OF, 1), "mrr_amount").alias("prior_mrr"),
    )
    by = per.join(lab.customers(geo=True).select("customer_id", "segment", "industry"), "customer_id").groupBy("segment", "industry", "product_name")
    both = by.agg(F.sum("current_mrr").alias("current_mrr"), F.sum("prior_mrr").alias("prior_mrr"))
    change = F.col("current_mrr") - F.col("prior_mrr")
    return both.select(
        "segment", "industry", "product_name", dbl("prior_mrr").alias("prior_mrr"), dbl("current_mrr").alias("current_mrr"),
        dbl(change).alias("mrr_change"), safe_pct(change, F.col("prior_mrr")).alias("pct_change"),
    )


def mrr_change_top(lab: Lab) -> DataFrame:
    return mrr_change(lab).filter("abs(mrr_change) > 0").orderBy(F.abs("mrr_change").desc(), "segment", "industry", "product_name").limit(10)


def compare_periods(current: DataFrame, prior: DataFrame, keys: list[str], measure: str) -> DataFrame:
    """Full outer comparison of two aggregated periods on several keys."""
    c = current.select(*keys, F.col(measure).alias("current_value"))
    p = prior.select(*keys, F.col(measure).alias("prior_value"))
    now, was = F.coalesce("current_value", F.lit(0).cast(MONEY)), F.coalesce("prior_value", F.lit(0).cast(MONEY))
    return c.join(p, keys, "full").select(
        *keys, dbl(was).alias("prior_value"), dbl(now).alias("current_value"), dbl(now - was).alias("change"), safe_pct(now - was, was).alias("pct_change")
    )


def new_mrr_compare(lab: Lab) -> DataFrame:
    """Revenue that started last month against the month before, by segment, industry and product."""
    started = lab.subscriptions(since=F.trunc(months_before(ORDERS_AS_OF, 2), "month")).withColumn("m", month_of("start_date")).join(lab.customers(geo=True).select("customer_id", "segment", "industry"), "customer_id")
    keys = ["segment", "industry", "product_name"]
    month = lambda back: started.filter(F.col("m") == F.trunc(months_before(ORDERS_AS_OF, back), "month")).groupBy(*keys).agg(F.sum("mrr_amount").alias("mrr"))
    return compare_periods(month(1), month(2), keys, "mrr")


def _object(df: DataFrame, key: str, value: str) -> DataFrame:
    """OBJECT_AGG over an already aggregated frame: one JSON object with sorted keys."""
    entries = F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), F.col(value).alias("v"))))
    return df.agg(F.to_json(F.map_from_entries(entries)).alias("data"))


def dashboard_sections(lab: Lab) -> DataFrame:
    customers, health = lab.customers(), lab.health_scores()
    newest = health.filter(F.col("snapshot_date") == health.agg(F.max("snapshot_date")).scalar())
    active = customers.filter("account_status = 'Active'")
    subs = lab.subscriptions().filter("status = 'Active'")
    keys = customers.sparkSession.range(1).select(
        F.to_json(F.struct(
            active.agg(F.count("*")).scalar().alias("active_customers"),
            subs.agg(F.sum("mrr_amount").cast(MONEY)).scalar().alias("total_mrr"),
            newest.agg(mean("overall_health_score", 2)).scalar().alias("avg_health_score"),
            newest.filter(F.col("churn_risk").isin("High", "Critical")).agg(F.count_distinct("customer_id")).scalar().alias("at_risk_customers"),
        )).alias("data")
    )
    sections = {
        "Key Metrics": keys,
        "Segment Distribution": _object(active.groupBy("segment").agg(F.count("*").alias("n")), "segment", "n"),
        "Product Revenue": _object(subs.groupBy("product_name").agg(F.sum("mrr_amount").cast(MONEY).alias("n")), "product_name", "n"),
        "Health Distribution": _object(newest.groupBy("churn_risk").agg(F.count_distinct("customer_id").alias("n")), "churn_risk", "n"),
    }
    return union_padded(*(df.select(F.lit(s).alias("section"), "data") for s, df in sections.items()))


def key_metrics(lab: Lab) -> DataFrame:
    customers, health = lab.customers(), lab.health_scores()
    newest = health.filter(F.col("snapshot_date") == health.agg(F.max("snapshot_date")).scalar())
    first_recent = days_before(EVENTS_AS_OF, 30)
    return customers.sparkSession.range(1).select(
        customers.filter("account_status = 'Active'").agg(F.count("*")).scalar().alias("active_customers"),
        customers.filter("account_status = 'Churned'").agg(F.count("*")).scalar().alias("churned_customers"),
        lab.subscriptions().filter("status = 'Active'").agg(dbl(F.sum("mrr_amount"))).scalar().alias("total_mrr"),
        newest.agg(mean("overall_health_score")).scalar().alias("avg_health_score"),
        lab.feedback().filter(F.col("submitted_date") >= first_recent).agg(mean("nps_score")).scalar().alias("avg_nps"),
        lab.tickets().filter("status = 'Open'").agg(F.count("*")).scalar().alias("open_tickets"),
    )


# -- agents -----------------------------------------------------------------


def agent_usage(lab: Lab) -> DataFrame:
    role = F.col("message_role")
    return lab.conversations().groupBy("agent_name", F.to_date("message_timestamp").alias("usage_date")).agg(
        F.count_distinct("conversation_id").alias("conversations"), count_when(role == "user").alias("user_messages"),
        count_when(role == "assistant").alias("assistant_responses"), F.count_distinct("user_id").alias("unique_users"),
    )


def response_time(lab: Lab) -> DataFrame:
    """Seconds since the previous message; the ordered scan keeps a huge conversation distributed."""
    talk = lab.conversations().select(
        "conversation_id", "user_id", "agent_name", "message_role", "turn", F.left("message_content", F.lit(500)).alias("message_preview"), "message_timestamp"
    )
    out = ordered_scan(talk, ["conversation_id"], [F.col("message_timestamp"), F.col("turn")], lag={"prev_message_time": "message_timestamp"})
    return out.withColumn("response_time_seconds", F.timestamp_diff("SECOND", F.col("prev_message_time"), F.col("message_timestamp")))


# -- parameterised table functions --------------------------------------------


def _agent_frame(lab: Lab) -> DataFrame:
    seen = lab.usage_daily().groupBy("customer_id").agg(day_diff(F.max("usage_date"), day(EVENTS_AS_OF)).alias("days_since_login"))
    tickets = lab.tickets().filter(F.col("status").isin(OPEN)).groupBy("customer_id").agg(F.count("*").alias("open_tickets"))
    health = latest_health(lab).select("customer_id", "overall_health_score", "churn_risk", "health_trend")
    return (
        lab.customers(geo=True).filter("account_status = 'Active'").drop("mrr")
        .join(active_revenue(lab).select("customer_id", F.col("total_mrr").alias("mrr")), "customer_id", "left")
        .join(health, "customer_id", "left").join(tickets, "customer_id", "left").join(seen, "customer_id", "left")
    )


def customer_lookup(lab: Lab, name_pattern: str) -> DataFrame:
    """Customer 360 by case-insensitive name fragment."""
    hit = F.lower("company_name").contains(name_pattern.lower())
    return _agent_frame(lab).filter(hit).select(
        "customer_id", F.col("company_name").alias("customer_name"), "segment", "industry", dbl(F.coalesce("mrr", F.lit(0))).alias("mrr"),
        F.col("overall_health_score").alias("health_score"), "churn_risk", F.coalesce("open_tickets", F.lit(0)).alias("open_tickets"),
        F.coalesce("days_since_login", F.lit(999)).alias("last_login_days_ago"),
    )


def at_risk_customers(lab: Lab, min_mrr: float = 0) -> DataFrame:
    """High and critical churn risk, optionally from a minimum revenue."""
    mrr, quiet = F.coalesce("mrr", F.lit(0)), F.coalesce("days_since_login", F.lit(999))
    summary = (
        F.when((F.col("churn_risk") == "Critical") & (mrr > 500), labels.RISK["high_value"])
        .when(F.col("churn_risk") == "Critical", labels.RISK["critical"])
        .when(F.col("health_trend") == "Declining", labels.RISK["declining"])
        .when(quiet > 30, labels.RISK["quiet"])
        .otherwise(labels.RISK["other"])
    )
    return _agent_frame(lab).filter(F.col("churn_risk").isin("High", "Critical") & (mrr >= min_mrr)).orderBy(F.col("mrr").desc_nulls_last(), "customer_id").select(
        F.col("company_name").alias("customer_name"), "segment", "industry", dbl(mrr).alias("mrr"), F.col("overall_health_score").alias("health_score"),
        "churn_risk", "health_trend", quiet.alias("days_since_login"), summary.alias("risk_summary"),
    )


def tenant_extract(lab: Lab, customer_id: int) -> DataFrame:
    """One tenant's users and subscriptions: the key filter reaches all three scans."""
    mine = F.col("customer_id") == customer_id
    c = lab.customers().filter(mine).select("customer_id", "company_name")
    u = lab.users().filter(mine).select("customer_id", "user_id", "first_name", "last_name", "role", "last_login_date")
    s = lab.subscriptions().filter(mine).select("customer_id", "product_name", "plan_tier", F.col("status").alias("subscription_status"))
    return c.join(u, "customer_id").join(s, "customer_id")


# -- row counts -----------------------------------------------------------------


def _all_tables(lab: Lab) -> dict[str, DataFrame]:
    return {
        "CUSTOMERS": lab.customers(), "USERS": lab.users(), "SUBSCRIPTIONS": lab.subscriptions(), "USAGE_DAILY": lab.usage_daily(),
        "HEALTH_SCORES": lab.health_scores(), "FEEDBACK": lab.feedback(), "TICKETS": lab.tickets(), "CONVERSATIONS": lab.conversations(),
    }


def row_count_report(lab: Lab) -> DataFrame:
    dated = {"CUSTOMERS": "created_date", "SUBSCRIPTIONS": "start_date", "FEEDBACK": "submitted_date"}
    parts = []
    for name, df in _all_tables(lab).items():
        if name in dated:
            d = dated[name]
            parts.append(df.agg(F.count("*").alias("row_count"), F.min(d).alias("earliest_date"), F.max(d).alias("latest_date")).withColumn("table_name", F.lit(name)))
        else:
            parts.append(df.agg(F.count("*").alias("row_count")).withColumn("table_name", F.lit(name)))
    return union_padded(*parts).select("table_name", "row_count", "earliest_date", "latest_date")


def total_records(lab: Lab) -> DataFrame:
    return row_counts(_all_tables(lab)).agg(F.sum("row_count").alias("total_records"))


QUERIES = {
    "segment_ranking": segment_ranking, "ranked_customers": ranked_customers, "segment_matrix": segment_matrix, "segment_summary": segment_summary,
    "revenue_by_segment": revenue_by_segment, "active_products": active_products, "customer_listing": customer_listing,
    "customer_360_faithful": customer_360_faithful, "customer_360": customer_360, "cohort_revenue": cohort_revenue, "revenue_churn": revenue_churn,
    "revenue_six_months": revenue_six_months, "executive_kpis": executive_kpis, "health_dashboard": health_dashboard, "top_at_risk": top_at_risk,
    "shared_customer_summary": shared_customer_summary, "executive_metrics": executive_metrics, "product_usage_month": product_usage_month,
    "analytics_base_customer": analytics_base_customer, "analytics_base_revenue": analytics_base_revenue, "analytics_base_usage": analytics_base_usage,
    "analytics_base_support": analytics_base_support, "mrr_history": mrr_history, "daily_usage": daily_usage, "mrr_change": mrr_change,
    "mrr_change_top": mrr_change_top, "new_mrr_compare": new_mrr_compare, "dashboard_sections": dashboard_sections, "key_metrics": key_metrics,
    "agent_usage": agent_usage, "response_time": response_time, "tvf_customer_360": lambda lab: customer_lookup(lab, "customer#0000001"),
    "tvf_at_risk": at_risk_customers, "tenant_extract": lambda lab: tenant_extract(lab, 7), "row_counts": row_count_report, "total_records": total_records,
}
