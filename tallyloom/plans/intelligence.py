"""Forecasts, anomalies, the semantic model, semantic views and the verified questions on them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.dates import month_of
from tallyloom.functions.numbers import count_when, dbl, mean, rounded, safe_div, safe_pct
from tallyloom.operators.semantic import Named, SemanticModel, query_facts, query_metrics, semantic_view
from tallyloom.operators.series import anomalies, forecast
from tallyloom.plans.products import _customer_base, _mrr_history, _revenue_base, _support_base, _usage_base, daily_usage
from tallyloom.sources.lab import Lab

# -- series ----------------------------------------------------------------


def mrr_forecast(lab: Lab) -> DataFrame:
    """History of active revenue and the next six months with bounds."""
    series = _mrr_history(lab).filter("month < DATE'2001-08-01'").select(F.lit("all").alias("series"), "month", "total_mrr")
    return forecast(series, ["series"], "month", "total_mrr", 6)


def product_forecast(lab: Lab) -> DataFrame:
    monthly = lab.subscriptions().filter("status = 'Active' AND start_date < DATE'2001-08-01'").groupBy("product_name", month_of("start_date").alias("month")).agg(F.sum("mrr_amount").alias("mrr"))
    return forecast(monthly, ["product_name"], "month", "mrr", 6)


def login_anomalies(lab: Lab) -> DataFrame:
    series = daily_usage(lab).select(F.lit("all").alias("series"), "usage_date", "total_logins")
    return anomalies(series, ["series"], "usage_date", "total_logins")


def flagged_anomalies(lab: Lab) -> DataFrame:
    """Anomalous days per event type only."""
    daily = lab.raw("events").groupBy("event_type", F.to_date("ts").alias("usage_date")).agg(F.count("*").alias("n"))
    return anomalies(daily, ["event_type"], "usage_date", "n").filter("is_anomaly")


# -- semantic model ------------------------------------------------------------


def model(lab: Lab) -> SemanticModel:
    nps = F.col("nps_score")
    category = F.when(nps >= 9, "Promoter").when(nps >= 7, "Passive").otherwise("Detractor")
    return SemanticModel(
        tables={
            "customers": lab.customers(geo=True),
            "subscriptions": lab.subscriptions(),
            "feedback": lab.feedback().select("feedback_id", "customer_id", "nps_score"),
            "industries": lab.raw("region").select(F.col("r_name").alias("industry"), F.col("r_regionkey").alias("industry_no")),
        },
        keys={"industries": "industry", "customers": "customer_id", "subscriptions": "subscription_id", "feedback": "feedback_id"},
        relationships=[("subscriptions", "customer_id", "customers"), ("feedback", "customer_id", "customers"), ("customers", "industry", "industries")],
        dimensions={
            "customer_id": Named("customers", F.col("customer_id"), "Customer ID"),
            "segment": Named("customers", F.col("segment"), "Customer Segment", ("tier", "size", "customer tier")),
            "industry": Named("customers", F.col("industry"), "Industry Type"),
            "industry_no": Named("industries", F.col("industry_no"), "Industry Number"),
            "product": Named("subscriptions", F.col("product_name"), "Product Name", ("subscription product",)),
            "subscription_status": Named("subscriptions", F.col("status"), "Subscription Status"),
            "nps_category": Named("feedback", category, "NPS Category"),
        },
        facts={
            "customer_mrr": Named("customers", F.col("mrr"), "Customer MRR"), "health_score": Named("customers", F.col("health_score"), "Health Score"),
            "subscription_mrr": Named("subscriptions", F.col("mrr_amount"), "Subscription MRR"), "nps_score": Named("feedback", nps, "NPS Score"),
        },
        metrics={
            "customer_count": Named("customers", F.count_distinct("customer_id"), "Number of Customers", ("total customers", "customer total")),
            "total_mrr": Named("customers", dbl(F.sum("mrr")), "Total MRR", ("monthly revenue", "revenue")),
            "average_mrr": Named("customers", mean("mrr", 2), "Average MRR", ("avg MRR", "ARPU")),
            "avg_health_score": Named("customers", mean("health_score"), "Average Health Score"),
            "subscription_count": Named("subscriptions", F.count("subscription_id"), "Number of Subscriptions"),
            "avg_nps": Named("feedback", mean("nps_score"), "Average NPS Score", ("NPS score", "satisfaction score")),
            "promoter_count": Named("feedback", count_when(nps >= 9), "Number of Promoters"),
            "detractor_count": Named("feedback", count_when(nps <= 6), "Number of Detractors"),
        },
    )


def metrics_by_segment(lab: Lab) -> DataFrame:
    return query_metrics(model(lab), ["customer_count", "total_mrr", "avg_health_score"], ["segment"])


def metrics_all_tables(lab: Lab) -> DataFrame:
    """Every metric by segment and industry, from three tables without fan-out."""
    m = model(lab)
    return query_metrics(m, list(m.metrics), ["segment", "industry"])


def metrics_by_synonym(lab: Lab) -> DataFrame:
    return query_metrics(model(lab), ["ARPU", "satisfaction score"], ["tier"])


def metrics_two_hops(lab: Lab) -> DataFrame:
    """Survey and subscription metrics by an attribute two relationships away."""
    return query_metrics(model(lab), ["NPS score", "subscription_count"], ["industry_no"])


def facts_by_row(lab: Lab) -> DataFrame:
    """Facts of subscriptions and their customers, one row per subscription."""
    return query_facts(model(lab), ["subscription_mrr", "customer_mrr", "health_score"], ["product", "segment", "industry_no"]).withColumns({c: dbl(c) for c in ("subscription_mrr", "customer_mrr")})


def nps_metrics(lab: Lab) -> DataFrame:
    return query_metrics(model(lab), ["promoter_count", "detractor_count", "avg_nps"], ["nps_category", "segment"])


def subscription_metrics(lab: Lab) -> DataFrame:
    return query_metrics(model(lab), ["subscription_count"], ["product", "subscription_status", "segment"])


# -- semantic views --------------------------------------------------------------

CUSTOMER_COLUMNS = {
    "customer_id": "Key of the account", "customer_name": "Name the account signs with", "customer_segment": "Market the account is counted in", "industry": "Line of business, from the region",
    "state": "Nation the account is registered in", "account_status": "State of the contract as a whole", "customer_success_manager": "Who looks after the account",
    "customer_since_date": "Day of the first contract", "customer_tenure_months": "Calendar months since that day", "customer_tenure_years": "Calendar years since that day",
    "overall_health_score": "Weighted mean of the five component scores, 0 to 100", "usage_score": "Health component: how much is used", "engagement_score": "Health component: how often people return",
    "support_score": "Health component: how smoothly requests end", "payment_score": "Health component: how promptly bills are paid", "churn_risk": "Band of the overall health score",
    "health_trend": "Direction of the health score since the snapshot before",
}
REVENUE_COLUMNS = {
    "subscription_id": "Key of the contract line", "customer_id": "Account that pays", "customer_name": "Name of the paying account", "customer_segment": "Market of the paying account",
    "industry": "Line of business of the paying account", "product_name": "What is subscribed to", "plan_tier": "Size of the plan", "subscription_status": "State of the contract line",
    "subscription_start_date": "First day that is billed", "subscription_end_date": "Last day that is billed, empty while it runs", "cohort_month": "Month of the first billed day", "cohort_quarter": "Quarter of the first billed day",
    "cohort_year": "Year of the first billed day", "monthly_recurring_revenue": "List price per month", "annual_recurring_revenue": "List price per twelve months",
    "net_mrr": "Price per month with the discount taken off", "discount_percent": "Share of the list price that is waived",
}
USAGE_COLUMNS = {
    "usage_date": "Day the activity is counted on", "usage_week": "Monday of that day's week", "usage_month": "First of that day's month", "day_of_week": "Weekday in words", "customer_id": "Account of the person",
    "customer_name": "Name of that account", "customer_segment": "Market of that account", "industry": "Line of business of that account", "user_id": "Person who was active", "emails_sent": "Mails that left",
    "emails_opened": "Mails that a recipient read", "emails_clicked": "Mails whose link was followed", "email_open_rate": "Read mails per hundred sent", "email_click_rate": "Followed mails per hundred read",
    "social_posts": "Posts on networks", "messages_sent": "Short messages that left", "total_messages": "Mails, posts and short messages together", "total_logins": "Times the person came in", "session_minutes": "Minutes the person stayed",
}
SUPPORT_COLUMNS = {
    "ticket_id": "Key of the request", "customer_id": "Account that asks", "customer_name": "Name of that account", "customer_segment": "Market of that account",
    "ticket_category": "Subject of the request", "ticket_priority": "Urgency as set on arrival", "ticket_status": "State of the request", "ticket_created_date": "Day of arrival", "ticket_month": "Month of arrival",
    "resolution_time_hours": "Hours from arrival to answer", "customer_satisfaction_score": "Grade the asker gave, 1 to 5", "sla_met": "True if the answer came in time",
    "is_resolved": "1 once answered, for sums", "is_high_priority": "1 for the two most urgent levels, for sums",
}


def customers_view(lab: Lab) -> DataFrame:
    return semantic_view(_customer_base(lab), CUSTOMER_COLUMNS)


def revenue_view(lab: Lab) -> DataFrame:
    return semantic_view(_revenue_base(lab), REVENUE_COLUMNS, {"monthly_recurring_revenue": "mrr", "annual_recurring_revenue": "arr"})


def usage_view(lab: Lab) -> DataFrame:
    return semantic_view(_usage_base(lab), USAGE_COLUMNS)


def support_view(lab: Lab) -> DataFrame:
    return semantic_view(_support_base(lab), SUPPORT_COLUMNS, {"customer_satisfaction_score": "csat"})


def _live(lab: Lab) -> DataFrame:
    return customers_view(lab).filter("account_status = 'Active'")


def _paying(lab: Lab) -> DataFrame:
    return revenue_view(lab).filter("subscription_status = 'Active'")


def segment_view_query(lab: Lab) -> DataFrame:
    return _live(lab).groupBy("customer_segment").agg(F.count("*").alias("customers"), mean("overall_health_score", 1).alias("avg_health"))


def product_view_query(lab: Lab) -> DataFrame:
    return _paying(lab).groupBy("product_name").agg(dbl(F.sum("mrr")).alias("total_mrr"), F.count("*").alias("subscriptions"))


# question -> (view, category, query); the questions are fixed values
VERIFIED = {
    "verified_01": ("How many active customers do we have?", "Customer", lambda lab: _live(lab).agg(F.count("*").alias("active_customers"))),
    "verified_02": ("What is the breakdown of customers by segment?", "Customer", lambda lab: _live(lab).groupBy("customer_segment").agg(F.count("*").alias("customer_count"))),
    "verified_03": ("Which customers have critical churn risk?", "Customer", lambda lab: _live(lab).filter("churn_risk = 'Critical'").select("customer_name", "customer_segment", "overall_health_score", "churn_risk")),
    "verified_04": ("What is the average health score by industry?", "Customer", lambda lab: _live(lab).groupBy("industry").agg(mean("overall_health_score", 1).alias("avg_health_score"))),
    "verified_05": ("What is our total MRR?", "Revenue", lambda lab: _paying(lab).agg(dbl(F.sum("mrr")).alias("total_mrr"))),
    "verified_06": ("What is the MRR by product?", "Revenue", lambda lab: _paying(lab).groupBy("product_name").agg(dbl(F.sum("mrr")).alias("total_mrr"))),
    "verified_07": ("What is the MRR by segment?", "Revenue", lambda lab: _paying(lab).groupBy("customer_segment").agg(dbl(F.sum("mrr")).alias("total_mrr"), F.count_distinct("customer_id").alias("customers"))),
    "verified_08": ("What is our average MRR per customer?", "Revenue", lambda lab: _paying(lab).agg(rounded(safe_div(F.sum("mrr"), F.count_distinct("customer_id")), 2).alias("avg_mrr_per_customer"))),
    "verified_09": ("How much revenue churned this month?", "Revenue", lambda lab: revenue_view(lab).filter("subscription_status = 'Cancelled' AND subscription_end_date >= DATE'2001-08-01'").agg(dbl(F.sum("mrr")).alias("churned_mrr"))),
    "verified_10": ("How many emails were sent last month?", "Usage", lambda lab: usage_view(lab).filter("usage_month = DATE'2024-01-01'").agg(F.sum("emails_sent").alias("total_emails"))),
    "verified_11": ("What is the average email open rate?", "Usage", lambda lab: usage_view(lab).filter("emails_sent > 0").agg(mean("email_open_rate", 2).alias("avg_open_rate"))),
    "verified_12": ("Which customers have the most messages?", "Usage", lambda lab: usage_view(lab).groupBy("customer_name").agg(F.sum("total_messages").alias("total_messages")).orderBy(F.desc("total_messages"), "customer_name").limit(10)),
    "verified_13": ("What is the average session duration by segment?", "Usage", lambda lab: usage_view(lab).groupBy("customer_segment").agg(mean("session_minutes", 1).alias("avg_session_minutes"))),
    "verified_14": ("How many open tickets do we have?", "Support", lambda lab: support_view(lab).filter(F.col("ticket_status").isin("Open", "In Progress")).agg(F.count("*").alias("open_tickets"))),
    "verified_15": ("What is the average resolution time?", "Support", lambda lab: support_view(lab).filter("is_resolved = 1").agg(mean("resolution_time_hours", 1).alias("avg_resolution_hours"))),
    "verified_16": ("What is our average CSAT score?", "Support", lambda lab: support_view(lab).filter("csat IS NOT NULL").agg(mean("csat", 2).alias("avg_csat"))),
    "verified_17": ("What percentage of tickets meet SLA?", "Support", lambda lab: support_view(lab).agg(safe_pct(count_when(F.col("sla_met")), F.count("*"), 1).alias("sla_met_pct"))),
}

QUERIES = {f.__name__: f for f in [
    mrr_forecast, product_forecast, login_anomalies, flagged_anomalies, metrics_by_segment, metrics_all_tables, metrics_by_synonym, metrics_two_hops, facts_by_row, nps_metrics, subscription_metrics,
    segment_view_query, product_view_query,
]} | {name: build for name, (_, _, build) in VERIFIED.items()}
