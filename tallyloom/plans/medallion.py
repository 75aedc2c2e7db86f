"""Bronze, silver and gold layers.

Bronze keeps each source row as one VARIANT with audit columns. Silver extracts,
types, validates and deduplicates. Gold aggregates silver. Every node is a
DataFrame function of its inputs, so refreshing is re-running, or running the
same functions on a micro-batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom import labels
from tallyloom.functions.dates import day, month_diff
from tallyloom.functions.numbers import count_when, dbl, mean, rounded, safe_div, safe_pct, sum_when
from tallyloom.operators.latest import latest_per_key
from tallyloom.sources.lab import ORDERS_AS_OF, Lab
from tallyloom.sources.tables import row_counts

FIRST_LOAD, SECOND_LOAD = "2024-01-01 00:00:00", "2024-01-02 00:00:00"


def land(df: DataFrame, source: str, batch: str, ingested_at: str) -> DataFrame:
    """Pack each row into one VARIANT with upper-case keys; NULL fields are absent."""
    fields = F.struct(*[F.col(c).alias(c.upper()) for c in df.columns])
    return df.select(
        F.parse_json(F.to_json(fields)).alias("_raw_data"), F.lit(source).alias("_source_system"),
        F.lit(ingested_at).cast("timestamp_ntz").alias("_ingested_at"), F.lit(batch).alias("_batch_id"),
    )


def field(name: str, to: str = "string") -> Column:
    """A field of the raw VARIANT; a missing path or a bad cast gives NULL."""
    return F.try_variant_get("_raw_data", f"$.{name}", to)


# -- bronze ----------------------------------------------------------------


def bronze_customers(lab: Lab) -> DataFrame:
    """A first full load and a later batch with corrected revenue, some bad scores and bad dates."""
    base = lab.customers(geo=True).select("customer_id", "company_name", "segment", "industry", "mrr", "health_score", F.col("created_date").cast("string").alias("created_date"))
    later = base.filter("customer_id % 10 = 0").withColumns({
        "mrr": (F.col("mrr") + 100).cast("decimal(18,2)"),
        "health_score": F.when(F.col("customer_id") % 50 == 0, F.lit(101)).when(F.col("customer_id") % 70 == 0, F.lit(None)).otherwise(F.col("health_score")),
        "created_date": F.when(F.col("customer_id") % 40 == 0, F.lit("2022-13-01")).otherwise(F.col("created_date")),
    })
    return land(base, "crm", "batch_2024_001", FIRST_LOAD).unionByName(land(later, "crm", "batch_2024_002", SECOND_LOAD))


def bronze_subscriptions(lab: Lab) -> DataFrame:
    base = lab.subscriptions().select(
        "subscription_id", "customer_id", F.col("product_name").alias("product"), F.col("mrr_amount").alias("mrr"), "status", F.col("start_date").cast("string").alias("start_date")
    )
    return land(base, "billing", "batch_2024_001", FIRST_LOAD)


def bronze_users(lab: Lab) -> DataFrame:
    return land(lab.users().select("user_id", "customer_id", "email", "phone", "full_name", "role"), "identity", "batch_2024_001", FIRST_LOAD)


# -- silver ------------------------------------------------------------------


def typed_customers(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        field("CUSTOMER_ID", "bigint").alias("customer_id"), field("COMPANY_NAME").alias("company_name"), F.upper(field("SEGMENT")).alias("segment"),
        field("INDUSTRY").alias("industry"), field("MRR", "decimal(18,2)").alias("mrr"), field("HEALTH_SCORE", "int").alias("health_score"),
        F.try_to_date(field("CREATED_DATE"), "yyyy-MM-dd").alias("created_date"), "_source_system", "_ingested_at", "_batch_id",
    )


def newest_customers(typed: DataFrame) -> DataFrame:
    """The last row of every customer; rows of one batch are told apart by their content."""
    newest = latest_per_key(typed.withColumn("_tie", F.xxhash64(*typed.columns)), ["customer_id"], ["_ingested_at", "_batch_id", "_tie"]).drop("_tie").drop("_batch_id")
    return newest.withColumn("_dq_status", F.when(F.col("health_score").between(0, 100), labels.QUALITY["valid"]).otherwise(labels.QUALITY["bad_score"]))


def to_silver_customers(bronze: DataFrame) -> DataFrame:
    return newest_customers(typed_customers(bronze))


def load_customers(spark: SparkSession, root: str, load: int, arrived: DataFrame) -> DataFrame:
    """Store an arrived bronze batch and the silver rows after it, and read silver back.

    Only the batch is parsed: silver of the load before holds everything
    older. Each load writes folders of its own, so a repeat replaces its output.
    """
    arrived.write.mode("overwrite").parquet(f"{root}/bronze/load={load}")
    typed = typed_customers(spark.read.parquet(f"{root}/bronze/load={load}"))
    if load:
        older = spark.read.parquet(f"{root}/silver/load={load - 1}").drop("_dq_status").withColumn("_batch_id", F.lit(None).cast("string"))
        typed = typed.unionByName(older)
    newest_customers(typed).write.mode("overwrite").parquet(f"{root}/silver/load={load}")
    return spark.read.parquet(f"{root}/silver/load={load}")


def to_silver_subscriptions(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        field("SUBSCRIPTION_ID", "bigint").alias("subscription_id"), field("CUSTOMER_ID", "bigint").alias("customer_id"), field("PRODUCT").alias("product_name"),
        field("MRR", "decimal(18,2)").alias("mrr"), F.upper(field("STATUS")).alias("status"), F.try_to_date(field("START_DATE"), "yyyy-MM-dd").alias("start_date"),
        "_source_system", "_ingested_at",
    )


def to_silver_users(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        field("USER_ID", "bigint").alias("user_id"), field("CUSTOMER_ID", "bigint").alias("customer_id"), field("EMAIL").alias("email"),
        field("PHONE").alias("phone"), field("FULL_NAME").alias("full_name"), field("ROLE").alias("user_role"), "_source_system", "_ingested_at",
    )


# -- gold --------------------------------------------------------------------


def to_gold_customer_360(customers: DataFrame, subscriptions: DataFrame, users: DataFrame, fan_out: bool = False) -> DataFrame:
    """Per-customer profile; ``fan_out`` repeats each subscription per user, as joining first does."""
    owned = subscriptions.filter("status = 'ACTIVE'").groupBy("customer_id").agg(
        F.count("subscription_id").alias("product_count"), F.sum("mrr").alias("total_mrr"),
        F.array_join(F.array_sort(F.collect_set("product_name")), ", ").alias("products_owned"),
    )
    people = users.groupBy("customer_id").agg(F.count("user_id").alias("user_count"))
    copies = F.greatest(F.coalesce("user_count", F.lit(0)), F.lit(1)) if fan_out else F.lit(1)
    return customer_profile(customers, owned.withColumnsRenamed({"product_count": "n", "total_mrr": "owned_mrr"}), people, copies)


def customer_profile(customers: DataFrame, owned: DataFrame, people: DataFrame, copies: Column | None = None) -> DataFrame:
    """Profile rows from what each customer owns (n, owned_mrr, products_owned) and its user_count."""
    mrr = F.when(F.col("n") > 0, F.col("owned_mrr")) * (F.lit(1) if copies is None else copies)
    health = F.when(F.col("health_score") >= 80, labels.GOLD["healthy"]).when(F.col("health_score") >= 60, labels.GOLD["risk"]).otherwise(labels.GOLD["critical"])
    return customers.join(owned, "customer_id", "left").join(people, "customer_id", "left").select(
        "customer_id", "company_name", "segment", "industry", "health_score", "created_date",
        month_diff(F.col("created_date"), day(ORDERS_AS_OF)).alias("tenure_months"), F.coalesce("n", F.lit(0)).alias("product_count"),
        dbl(mrr).alias("total_mrr"), dbl(mrr * 12).alias("total_arr"), "products_owned", F.coalesce("user_count", F.lit(0)).alias("user_count"), health.alias("health_status"),
    )


def to_gold_revenue(customers: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Active revenue per segment; the health average weighs a customer by its subscription rows."""
    owned = subscriptions.filter("status = 'ACTIVE'").groupBy("customer_id").agg(F.count("*").alias("n"), F.sum("mrr").alias("owned_mrr"))
    rows = F.greatest(F.coalesce("n", F.lit(0)), F.lit(1))
    return customers.join(owned, "customer_id", "left").groupBy("segment").agg(
        F.count("customer_id").alias("customer_count"), dbl(F.sum("owned_mrr")).alias("total_mrr"), dbl(F.sum("owned_mrr") * 12).alias("total_arr"),
        rounded(safe_div(F.sum("owned_mrr"), F.sum("n")), 4).alias("avg_mrr_per_subscription"), F.coalesce(F.sum("n"), F.lit(0)).alias("subscription_count"),
        rounded(safe_div(F.sum(F.col("health_score") * rows), F.sum(F.when(F.col("health_score").isNotNull(), rows))), 4).alias("avg_health_score"),
    )


def to_gold_products(subscriptions: DataFrame) -> DataFrame:
    status = F.col("status")
    return subscriptions.groupBy("product_name").agg(
        F.count_distinct("customer_id").alias("customer_count"), F.count("subscription_id").alias("subscription_count"),
        dbl(sum_when(status == "ACTIVE", "mrr")).alias("active_mrr"), dbl(sum_when(status == "CANCELLED", "mrr")).alias("churned_mrr"),
        safe_pct(count_when(status == "CANCELLED"), F.count("*")).alias("churn_rate_pct"),
    )


def refresh(bronze: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All silver and gold frames from the bronze frames, in dependency order."""
    customers, subscriptions, users = to_silver_customers(bronze["customers"]), to_silver_subscriptions(bronze["subscriptions"]), to_silver_users(bronze["users"])
    return {
        "silver_customers": customers, "silver_subscriptions": subscriptions, "silver_users": users,
        "gold_customer_360": to_gold_customer_360(customers, subscriptions, users), "gold_revenue": to_gold_revenue(customers, subscriptions),
        "gold_products": to_gold_products(subscriptions),
    }


def _silver(lab: Lab) -> tuple[DataFrame, DataFrame, DataFrame]:
    return to_silver_customers(bronze_customers(lab)), to_silver_subscriptions(bronze_subscriptions(lab)), to_silver_users(bronze_users(lab))


def silver_customers(lab: Lab) -> DataFrame:
    return to_silver_customers(bronze_customers(lab)).withColumn("mrr", dbl("mrr"))


def silver_subscriptions(lab: Lab) -> DataFrame:
    return to_silver_subscriptions(bronze_subscriptions(lab)).withColumn("mrr", dbl("mrr"))


def silver_users(lab: Lab) -> DataFrame:
    return to_silver_users(bronze_users(lab))


def gold_customer_360(lab: Lab) -> DataFrame:
    return to_gold_customer_360(*_silver(lab))


def gold_customer_360_faithful(lab: Lab) -> DataFrame:
    return to_gold_customer_360(*_silver(lab), fan_out=True)


def gold_revenue(lab: Lab) -> DataFrame:
    return to_gold_revenue(to_silver_customers(bronze_customers(lab)), to_silver_subscriptions(bronze_subscriptions(lab)))


def gold_products(lab: Lab) -> DataFrame:
    return to_gold_products(to_silver_subscriptions(bronze_subscriptions(lab)))


def bronze_batches(lab: Lab) -> DataFrame:
    """Row count and mean score per batch, read from the raw VARIANT."""
    return bronze_customers(lab).groupBy("_batch_id", "_source_system").agg(F.count("*").alias("records"), mean(field("HEALTH_SCORE", "int")).alias("avg_health"))


def layer_counts(lab: Lab) -> DataFrame:
    layers = refresh({"customers": bronze_customers(lab), "subscriptions": bronze_subscriptions(lab), "users": bronze_users(lab)})
    return row_counts({"BRONZE": bronze_customers(lab), "SILVER": layers["silver_customers"], "GOLD": layers["gold_customer_360"]})


def event_properties(lab: Lab) -> DataFrame:
    """JSON strings parsed to VARIANT and read by path with a cast, per event type."""
    parsed = lab.raw("events").select("event_type", F.try_parse_json("props").alias("_raw_data"))
    k = field("k", "int")
    return parsed.groupBy("event_type").agg(F.count("*").alias("n"), F.sum(k).alias("sum_k"), count_when(field("absent").isNull()).alias("absent"), F.max(k).alias("max_k"))


QUERIES = {
    "silver_customers": silver_customers, "silver_subscriptions": silver_subscriptions, "silver_users": silver_users, "gold_customer_360": gold_customer_360,
    "gold_customer_360_faithful": gold_customer_360_faithful, "gold_revenue": gold_revenue, "gold_products": gold_products,
    "bronze_batches": bronze_batches, "layer_counts": layer_counts, "event_properties": event_properties,
}
