"""Governed reads, shared extracts, sensitive-data and quality profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.dates import day, month_of
from tallyloom.functions.masks import amount_mask, email_mask, name_mask, phone_mask, short_email_mask, short_name_mask, short_phone_mask
from tallyloom.functions.numbers import count_when, dbl, mean, rounded, safe_pct
from tallyloom.operators.access import Policy, apply_masks, governed, mask_by_tags, rows_by_owner, rows_by_status, tag_columns
from tallyloom.operators.ordered import group_median
from tallyloom.operators.quality import column_profile, repeated_keys, sensitive_columns
from tallyloom.plans.products import _shared_customer_summary
from tallyloom.sources.lab import ORDERS_AS_OF, Lab
from tallyloom.sources.shared import shared_path
from tallyloom.sources.tables import literal_rows, union_padded, write_table

USER_MASKS = {"email": email_mask, "phone": phone_mask, "first_name": name_mask, "last_name": name_mask}
SHORT_MASKS = {"email": short_email_mask, "phone": short_phone_mask, "full_name": short_name_mask}


def _people(lab: Lab) -> DataFrame:
    return lab.users().select("user_id", "customer_id", "full_name", "first_name", "last_name", "email", "phone", "role")


def masked_users(role: str):
    return lambda lab: apply_masks(_people(lab), USER_MASKS, role)


def masked_users_short(lab: Lab) -> DataFrame:
    return apply_masks(_people(lab), SHORT_MASKS, "analyst")


def tag_masked(lab: Lab) -> DataFrame:
    tagged = tag_columns(_people(lab), {"email": "DIRECT_IDENTIFIER", "phone": "DIRECT_IDENTIFIER", "full_name": "QUASI_IDENTIFIER"})
    return mask_by_tags(tagged, "analyst")


def revenue_masked(lab: Lab) -> DataFrame:
    """The same amounts as staff, viewer and outsider see them."""
    amounts = lab.subscriptions().select("subscription_id", dbl("mrr_amount").alias("mrr_amount"))
    return amounts.select(
        "subscription_id", *[amount_mask(F.col("mrr_amount"), r).alias(r) for r in ("analyst", "viewer", "outsider")]
    )


def governed_customers(lab: Lab) -> DataFrame:
    """Row filter and mask together: an analyst's view of the customer table."""
    policy = Policy(masks={"company_name": name_mask}, rows=rows_by_status())
    return governed(lab.customers(), policy, "analyst").withColumn("mrr", dbl("mrr"))


def status_rows(lab: Lab) -> DataFrame:
    """Visible customers per status for each role."""
    base = lab.customers()
    return union_padded(*(
        governed(base, Policy(rows=rows_by_status()), role).groupBy("account_status").agg(F.count("*").alias("customers")).withColumn("role", F.lit(role))
        for role in ("admin", "analyst", "outsider")
    ))


# Owner mapping (fixed values): one owner's user, a user who sees all
MAPPING = [("user_anna", "CSM3"), ("user_control", None)]


def owner_rows(lab: Lab) -> DataFrame:
    mapping = literal_rows(lab.spark, MAPPING, "user string, csm_name string")
    base = lab.customers()
    return union_padded(*(
        governed(base, Policy(rows=rows_by_owner(mapping, user)), role).groupBy("csm_owner").agg(F.count("*").alias("customers")).withColumns({"user": F.lit(user), "role": F.lit(role)})
        for user, role in [("user_anna", "analyst"), ("user_control", "viewer"), ("user_unknown", "analyst"), ("user_unknown", "engineer")]
    ))


def customers_with_tickets(lab: Lab) -> DataFrame:
    """EXISTS as a semi join: no ticket row is duplicated into the result."""
    urgent = lab.tickets().filter(F.col("priority") == "Urgent").select("customer_id")
    return lab.customers().join(urgent, "customer_id", "left_semi").select("customer_id", "company_name", "segment")


# -- shared extracts -------------------------------------------------------


def shared_customers(lab: Lab) -> DataFrame:
    from tallyloom.functions.dates import month_diff

    return lab.customers(geo=True).filter(F.col("account_status").isin("Active", "Paused")).select(
        "customer_id", "company_name", "segment", "industry", "state", "account_status", "created_date",
        month_diff(F.col("created_date"), day(ORDERS_AS_OF)).alias("tenure_months"), (F.col("account_status") == "Active").alias("is_active"),
    )


def shared_subscriptions(lab: Lab) -> DataFrame:
    pricing = F.when(F.col("discount_percent") > 0, "Discounted").otherwise("Standard")
    return lab.subscriptions().filter(F.col("status").isin("Active", "Paused")).select(
        "customer_id", "product_name", "plan_tier", "status", "start_date", dbl("mrr_amount").alias("mrr_amount"), dbl("arr_amount").alias("arr_amount"), pricing.alias("pricing_type")
    )


def shared_usage(lab: Lab) -> DataFrame:
    return lab.usage_daily().groupBy("customer_id", month_of("usage_date").alias("usage_month")).agg(
        F.sum("emails_sent").alias("total_emails_sent"), F.sum("social_posts").alias("total_social_posts"), F.sum("messages_sent").alias("total_texts"),
        F.sum("total_logins").alias("total_logins"), mean("session_minutes").alias("avg_session_duration"),
    )


def published_extract(lab: Lab) -> DataFrame:
    """The shared summary written to a consumer path, one directory per segment, and read back."""
    return write_table(shared_customers(lab), shared_path(lab.spark, "extract"), ["segment"])


def benchmark_k_anon(lab: Lab) -> DataFrame:
    """Industry benchmark with an exact median, only for groups of at least ten."""
    summary = _shared_customer_summary(lab)
    grouped = summary.groupBy("industry", "segment").agg(
        F.count("*").alias("sample_size"), mean("overall_health_score").alias("avg_health_score"), mean("tenure_months").alias("avg_tenure_months"), mean("products").alias("avg_products")
    ).filter("sample_size >= 10")
    median = group_median(summary, ["industry", "segment"], "mrr", "customer_id", "median_mrr")
    return grouped.join(median, ["industry", "segment"], "left").withColumn("median_mrr", rounded("median_mrr", 4))


# -- profiles ---------------------------------------------------------------


def pii_profile(lab: Lab) -> DataFrame:
    return sensitive_columns(lab.raw("documents")).withColumn("table_name", F.lit("documents")).unionByName(
        sensitive_columns(_people(lab)).withColumn("table_name", F.lit("users"))
    )


def dq_customers(lab: Lab) -> DataFrame:
    status = F.col("account_status")
    return lab.customers().agg(
        F.count("*").alias("total_rows"), F.count_distinct("customer_id").alias("unique_customers"), (F.count("*") - F.count("company_name")).alias("null_company_names"),
        (F.count("*") - F.count("segment")).alias("null_segments"), (F.count("*") - F.count("account_status")).alias("null_statuses"),
        count_when(~status.isin("Active", "Churned", "Paused", "Trial")).alias("invalid_statuses"), safe_pct(count_when(status == "Active"), F.count("*")).alias("pct_active"),
    ).withColumn("table_name", F.lit("CUSTOMERS"))


def dq_users(lab: Lab) -> DataFrame:
    return lab.users().agg(
        F.count("*").alias("total_rows"), F.count_distinct("user_id").alias("unique_users"), F.count_distinct("customer_id").alias("unique_customers"),
        (F.count("*") - F.count("email")).alias("null_emails"), count_when(~F.col("email").like("%@%.%")).alias("invalid_emails"),
        count_when(F.col("last_login_date") < F.add_months(day(ORDERS_AS_OF), -12)).alias("stale_users"), safe_pct(count_when(F.col("mfa_enabled")), F.count("*")).alias("pct_mfa_enabled"),
    ).withColumn("table_name", F.lit("USERS"))


def dq_generic(lab: Lab) -> DataFrame:
    return column_profile(lab.raw("documents")).withColumn("table_name", F.lit("documents")).unionByName(
        column_profile(_people(lab)).withColumn("table_name", F.lit("users"))
    )


def repeated_line_keys(lab: Lab) -> DataFrame:
    return repeated_keys(lab.raw("lineitem"), ["l_orderkey", "l_linenumber"])


QUERIES = {
    "masked_users_admin": masked_users("admin"), "masked_users_analyst": masked_users("analyst"), "masked_users_viewer": masked_users("viewer"), "masked_users_short": masked_users_short,
    "tag_masked": tag_masked, "revenue_masked": revenue_masked, "governed_customers": governed_customers, "rows_by_status": status_rows, "rows_by_owner": owner_rows,
    "customers_with_tickets": customers_with_tickets, "shared_customers": shared_customers, "shared_subscriptions": shared_subscriptions, "shared_usage": shared_usage,
    "published_extract": published_extract, "benchmark_k_anon": benchmark_k_anon, "pii_profile": pii_profile, "dq_customers": dq_customers, "dq_users": dq_users,
    "dq_generic": dq_generic, "repeated_line_keys": repeated_line_keys,
}
