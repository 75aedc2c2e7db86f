"""Change capture, incremental merges, snapshots and pipeline monitoring."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.dates import day, minute_diff, month_diff, month_of, second_diff
from tallyloom.functions.numbers import count_when, dbl, mean
from tallyloom.operators.changes import change_feed, merge_additive, merge_dimension, revenue_movements, revenue_movements_as_written
from tallyloom.plans.medallion import bronze_customers, bronze_subscriptions, field, land, load_customers, to_gold_revenue, to_silver_subscriptions
from tallyloom.sources.lab import EVENTS_AS_OF, ORDERS_AS_OF, Lab
from tallyloom.sources.shared import shared_path
from tallyloom.sources.snapshots import publish, read_as_of, write_snapshot
from tallyloom.sources.tables import delete_matching, delete_where, insert_if_absent, union_padded, update_where, write_table

MERGED_AT = "2024-01-31 00:00:00"


# -- two versions of customers and subscriptions -------------------------------


def _customers_before(lab: Lab) -> DataFrame:
    return lab.customers().drop("mrr", "health_score")


def _customers_after(lab: Lab) -> DataFrame:
    """Some accounts churn, some leave the table, some arrive."""
    base = _customers_before(lab)
    edited = update_where(delete_where(base, F.col("customer_id") % 17 == 0), F.col("customer_id") % 13 == 0, {"account_status": F.lit("Churned")})
    arrived = base.filter("customer_id % 19 = 0").withColumns({"customer_id": F.col("customer_id") + 1000000000, "company_name": F.concat("company_name", F.lit(" II"))})
    return edited.unionByName(arrived)


def _subscriptions_after(lab: Lab) -> DataFrame:
    base = lab.subscriptions()
    kept = delete_where(base, F.col("subscription_id") % 23 == 0)
    priced = F.when(F.col("subscription_id") % 11 == 0, F.col("mrr_amount") + 50).when(F.col("subscription_id") % 7 == 0, F.col("mrr_amount") - 25).otherwise(F.col("mrr_amount"))
    arrived = base.filter("subscription_id % 29 = 0").withColumn("subscription_id", F.col("subscription_id") + 1000000000)
    return kept.withColumn("mrr_amount", priced.cast("decimal(18,2)")).unionByName(arrived)


def customer_feed(lab: Lab) -> DataFrame:
    return change_feed(_customers_before(lab), _customers_after(lab), ["customer_id"])


def customer_changes(lab: Lab) -> DataFrame:
    return customer_feed(lab).drop("_row_id")


def _dimension(lab: Lab) -> DataFrame:
    tenure = month_diff(F.col("created_date"), day(ORDERS_AS_OF)).alias("tenure_months")
    return _customers_before(lab).select(
        (F.col("customer_id") + 1).alias("customer_sk"), "customer_id", "company_name", "segment", "account_status", "csm_owner", tenure,
        F.lit(True).alias("is_current"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("effective_from"), F.lit(None).cast("timestamp_ntz").alias("effective_to"),
    )


def _merged_dimension(lab: Lab, **options) -> DataFrame:
    feed = customer_feed(lab).withColumn("tenure_months", month_diff(F.col("created_date"), day(ORDERS_AS_OF)))
    return merge_dimension(
        _dimension(lab), feed, "customer_id", ["company_name", "segment", "account_status"], F.lit(MERGED_AT).cast("timestamp_ntz"), "customer_sk", **options
    )


def scd_merge(lab: Lab) -> DataFrame:
    return _merged_dimension(lab)


def scd_merge_as_written(lab: Lab) -> DataFrame:
    return _merged_dimension(lab, mode="as_written")


def scd_merge_with_deletes(lab: Lab) -> DataFrame:
    return _merged_dimension(lab, close_deleted=True)


USAGE_SUMS = ["total_emails", "total_social_posts", "total_messages", "total_logins", "total_session_minutes"]


def monthly_usage(daily: DataFrame) -> DataFrame:
    return daily.groupBy("customer_id", month_of("usage_date").alias("usage_month")).agg(
        F.sum("emails_sent").alias("total_emails"), F.sum("social_posts").alias("total_social_posts"), F.sum("messages_sent").alias("total_messages"),
        F.sum("total_logins").alias("total_logins"), F.sum("session_minutes").cast("decimal(28,2)").alias("total_session_minutes"), F.count_distinct("user_id").alias("active_users"),
    )


def usage_merge(lab: Lab) -> DataFrame:
    """Existing months plus a later batch; active users are the batch's own count where it has the month."""
    daily, split = lab.usage_daily(), day("2024-01-16")
    merged = merge_additive(
        monthly_usage(daily.filter(F.col("usage_date") < split)), monthly_usage(daily.filter(F.col("usage_date") >= split)),
        ["customer_id", "usage_month"], USAGE_SUMS, ["active_users"],
    )
    return merged.withColumn("total_session_minutes", dbl("total_session_minutes"))


def usage_recomputed(lab: Lab) -> DataFrame:
    """The exact monthly fact from the base table, with true distinct users."""
    return monthly_usage(lab.usage_daily()).withColumn("total_session_minutes", dbl("total_session_minutes"))


def mrr_movements(lab: Lab) -> DataFrame:
    moves = revenue_movements(lab.subscriptions(), _subscriptions_after(lab), day(ORDERS_AS_OF))
    return moves.withColumns({c: dbl(c) for c in ["previous_mrr", "new_mrr", "mrr_change"]})


def mrr_movements_as_written(lab: Lab) -> DataFrame:
    feed = change_feed(lab.subscriptions(), _subscriptions_after(lab), ["subscription_id"])
    return revenue_movements_as_written(feed, day(ORDERS_AS_OF)).withColumns({"new_mrr": dbl("new_mrr"), "mrr_change": dbl("mrr_change")})


# -- monitoring ----------------------------------------------------------------


def feed_status(lab: Lab) -> DataFrame:
    """Rows waiting in each feed and the time its consumer last ran."""
    pending = {
        "CUSTOMERS": (customer_feed(lab), scd_merge(lab).agg(F.max(F.coalesce("effective_to", "effective_from")))),
        "SUBSCRIPTIONS": (change_feed(lab.subscriptions(), _subscriptions_after(lab), ["subscription_id"]), lab.subscriptions().agg(F.max("start_date").cast("timestamp_ntz"))),
        "USAGE": (lab.usage_daily().filter(F.col("usage_date") >= day("2024-01-16")), lab.usage_daily().filter(F.col("usage_date") < day("2024-01-16")).agg(F.max("usage_date").cast("timestamp_ntz"))),
    }
    return union_padded(*(
        feed.agg(F.count("*").alias("pending_rows")).select(F.lit(f"{name}_STREAM").alias("stream_name"), "pending_rows", last.scalar().alias("last_processed"))
        for name, (feed, last) in pending.items()
    ))


def freshness(lab: Lab) -> DataFrame:
    """Minutes between the data of each refreshed table and the report time."""
    done = lab.refresh_log().filter("state = 'SUCCEEDED'").groupBy("name", "schema_name").agg(F.max("refresh_end_time").alias("data_timestamp"))
    lag = minute_diff(F.col("data_timestamp"), F.lit(f"{EVENTS_AS_OF} 00:00:00").cast("timestamp_ntz"))
    return done.select("name", "schema_name", "data_timestamp", lag.alias("current_lag_minutes"), F.when(lag <= 60, "WITHIN TARGET").otherwise("LATE").alias("target_status"))


def refresh_duration(lab: Lab) -> DataFrame:
    seconds = second_diff(F.col("refresh_start_time"), F.col("refresh_end_time"))
    return lab.refresh_log().filter(F.col("name").like("DT_%")).groupBy("name", "schema_name", "state").agg(
        F.count("*").alias("refreshes"), mean(seconds).alias("avg_seconds"), F.max(seconds).alias("max_seconds"), F.sum("rows_inserted").alias("rows_inserted")
    )


def recent_refreshes(lab: Lab) -> DataFrame:
    return lab.refresh_log().filter(F.col("schema_name").isin("SILVER", "GOLD")).orderBy(F.desc("refresh_start_time"), "refresh_id").limit(20).select(
        "refresh_id", F.col("name").alias("table_name"), F.col("schema_name").alias("layer"), "refresh_start_time",
        second_diff(F.col("refresh_start_time"), F.col("refresh_end_time")).alias("refresh_seconds"),
    )


def stream_status(lab: Lab) -> DataFrame:
    offsets = lab.raw("events").groupBy("user_id").agg(F.max("ts").alias("last_read")).select(
        F.concat(F.lit("STREAM_"), "user_id").alias("name"), F.when(F.col("user_id") % 10 != 0, F.col("last_read") + F.expr("INTERVAL 1 DAY")).alias("stale_after")
    )
    status = F.when(F.col("stale_after").isNull(), "NEVER CONSUMED").when(F.col("stale_after") < F.lit(f"{EVENTS_AS_OF} 00:00:00").cast("timestamp_ntz"), "STALE").otherwise("CURRENT")
    return offsets.withColumn("status", status)


# -- snapshots -------------------------------------------------------------------


def _history(lab: Lab) -> str:
    """Customers stored at two times: before and after the edits."""
    root = shared_path(lab.spark, "customers")
    write_snapshot(_customers_before(lab), root, "2024-01-01 00:00:00")
    write_snapshot(_customers_after(lab), root, "2024-01-02 00:00:00")
    return root


def as_of_read(lab: Lab) -> DataFrame:
    return read_as_of(lab.spark, _history(lab), at="2024-01-01 12:00:00")


def now_vs_then(lab: Lab) -> DataFrame:
    root = _history(lab)
    frames = {"NOW": read_as_of(lab.spark, root), "10 MIN AGO": read_as_of(lab.spark, root, offset_seconds=600)}
    return union_padded(*(
        df.agg(F.count("*").alias("customer_count"), count_when(F.col("account_status") == "Active").alias("active_count")).withColumn("time_point", F.lit(n)) for n, df in frames.items()
    ))


def restore_deleted(lab: Lab) -> DataFrame:
    """Current rows plus the rows of the earlier version whose key has gone."""
    root = _history(lab)
    now = read_as_of(lab.spark, root)
    return now.unionByName(insert_if_absent(now, read_as_of(lab.spark, root, at="2024-01-01 00:00:00"), ["customer_id"]))


def restore_by_predicate(lab: Lab) -> DataFrame:
    """A version that lost one segment is stored; the segment comes back from the version before it, without duplicates."""
    root = _history(lab)
    write_snapshot(delete_where(read_as_of(lab.spark, root), F.col("segment") == "BUILDING"), root, "2024-01-03 00:00:00")
    damaged, before = read_as_of(lab.spark, root), read_as_of(lab.spark, root, offset_seconds=86400)
    return damaged.unionByName(insert_if_absent(damaged, before.filter("segment = 'BUILDING'"), ["customer_id"]))


def delete_first_rows(lab: Lab) -> DataFrame:
    """DELETE … WHERE key IN (SELECT key … ORDER BY key LIMIT 5)."""
    base = _customers_before(lab)
    return delete_matching(base, base.select("customer_id").orderBy("customer_id").limit(5), ["customer_id"])


def working_copy(lab: Lab) -> DataFrame:
    """An edited copy beside its original: the original does not change."""
    root = shared_path(lab.spark, "customers-copy")
    original = _customers_before(lab)
    write_snapshot(update_where(original, F.col("company_name").like("Customer#0000001%"), {"account_status": F.lit("TEST_STATUS")}), root, "2024-01-01 00:00:00")
    frames = {"ORIGINAL": original, "CLONE": read_as_of(lab.spark, root)}
    return union_padded(*(
        df.agg(F.count("*").alias("total"), count_when(F.col("account_status") == "TEST_STATUS").alias("test_status_count")).withColumn("source", F.lit(n)) for n, df in frames.items()
    ))


def past_copy(lab: Lab) -> DataFrame:
    """A copy of an earlier version, then counted by status."""
    root, target = _history(lab), shared_path(lab.spark, "customers-past")
    write_snapshot(read_as_of(lab.spark, root, at="2024-01-01 00:00:00"), target, "2024-01-03 00:00:00")
    return read_as_of(lab.spark, target).groupBy("account_status").agg(F.count("*").alias("customers"))


def _fresh_batch(lab: Lab) -> DataFrame:
    """A batch of new customers, one per hundred existing ones, as bronze rows."""
    fresh = lab.customers(geo=True).filter("customer_id % 100 = 0").select(
        (F.col("customer_id") + 1000000000).alias("customer_id"), F.concat(F.lit("New Customer "), "customer_id").alias("company_name"),
        "segment", "industry", "mrr", (50 + F.col("customer_id") * 7 % 50).cast("int").alias("health_score"), F.lit("2024-01-31").alias("created_date"),
    )
    return land(fresh, "monthly_batch_load", "batch_2024_004", MERGED_AT)


def _staging(lab: Lab) -> DataFrame:
    """Production bronze rows plus the new batch."""
    return bronze_customers(lab).unionByName(_fresh_batch(lab))


def layer_refresh(lab: Lab) -> DataFrame:
    """Stored bronze, silver and gold: a new batch flows through without parsing what was loaded before."""
    root = shared_path(lab.spark, "layers")
    load_customers(lab.spark, root, 0, bronze_customers(lab))
    silver = load_customers(lab.spark, root, 1, _fresh_batch(lab))
    gold = to_gold_revenue(silver, to_silver_subscriptions(bronze_subscriptions(lab)))
    return write_table(gold, f"{root}/gold")


def reload_table(lab: Lab) -> DataFrame:
    """Truncate and reload: the second load replaces the first."""
    path = shared_path(lab.spark, "reloaded")
    write_table(_customers_before(lab), path)
    return write_table(_customers_after(lab), path)


def validate_staging(lab: Lab) -> DataFrame:
    """Staging against production per segment, with a pass or fail verdict."""
    def profile(df, prefix):
        return df.groupBy(field("SEGMENT").alias("segment")).agg(F.count("*").alias(f"{prefix}_rows"), mean(field("HEALTH_SCORE", "int")).alias(f"{prefix}_health"))
    both = profile(_staging(lab), "staging").join(profile(bronze_customers(lab), "production"), "segment", "full")
    passed = (F.col("staging_rows") >= F.col("production_rows")) & F.col("staging_health").between(0, 100)
    return both.withColumn("verdict", F.when(passed, "PASS").otherwise("FAIL"))


def batch_mix(lab: Lab) -> DataFrame:
    """Batch composition after publishing staging, with production kept as the previous version."""
    root, extract = shared_path(lab.spark, "bronze"), lambda df: df.select("_batch_id", field("CUSTOMER_ID", "bigint").alias("customer_id"))
    write_snapshot(extract(bronze_customers(lab)), root, "2024-01-30 00:00:00")
    live = publish(lab.spark, root, extract(_staging(lab)), MERGED_AT)
    previous = read_as_of(lab.spark, root, at="2024-01-30 00:00:00")
    count = lambda df, n: df.groupBy("_batch_id").agg(F.count("*").alias("records")).withColumn("version", F.lit(n))
    return count(live, "production").unionByName(count(previous, "rollback"))


def enrich_absent(lab: Lab) -> DataFrame:
    """Answers not yet in the enriched table: only these go through enrichment again."""
    done = lab.feedback().filter("feedback_id % 3 = 0").select("feedback_id")
    return insert_if_absent(done, lab.feedback().select("feedback_id", "customer_id", "nps_score"), ["feedback_id"])


QUERIES = {
    "customer_changes": customer_changes, "scd_merge": scd_merge, "scd_merge_as_written": scd_merge_as_written, "scd_merge_with_deletes": scd_merge_with_deletes,
    "usage_merge": usage_merge, "usage_recomputed": usage_recomputed, "mrr_movements": mrr_movements, "mrr_movements_as_written": mrr_movements_as_written,
    "feed_status": feed_status, "freshness": freshness, "refresh_duration": refresh_duration, "recent_refreshes": recent_refreshes, "stream_status": stream_status,
    "as_of_read": as_of_read, "now_vs_then": now_vs_then, "restore_deleted": restore_deleted, "restore_by_predicate": restore_by_predicate,
    "delete_first_rows": delete_first_rows, "working_copy": working_copy, "past_copy": past_copy, "validate_staging": validate_staging, "batch_mix": batch_mix, "enrich_absent": enrich_absent,
    "layer_refresh": layer_refresh, "reload_table": reload_table,
}
