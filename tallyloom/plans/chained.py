"""Chained refresh: a bronze batch of any entities moves silver and gold by its changes.

Only the batch is parsed. Silver keeps the newest row of every key; a first load is
its own change and is read back by column, and of a later one the signed
changes of silver move the states behind gold (subscriptions and users per customer,
counted products per customer, sums per product and per segment), and gold rows of
the touched customers, products and segments are written anew. A batch that was
applied is not applied again: every table's log names the batches it holds, and a
repeat after a failure goes on where tables lack the batch, from states that are
read as of the batches before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.numbers import dbl, rounded, safe_div, safe_pct
from tallyloom.operators.deltas import entered, moved_state, signed_changes, signed_sum
from tallyloom.operators.latest import latest_per_key
from tallyloom.plans.incremental import MERGED_AT
from tallyloom.plans.medallion import (
    bronze_customers, bronze_subscriptions, bronze_users, customer_profile, land, newest_customers, to_silver_subscriptions, to_silver_users, typed_customers,
)
from tallyloom.sources.keyed import KeyedTable
from tallyloom.sources.lab import Lab
from tallyloom.sources.shared import cut_lineage, shared_path

OWNED = "customer_id bigint, n bigint, owned_mrr decimal(28,2)"
OWNS = "customer_id bigint, product_name string, n bigint, n_active bigint"
PEOPLE = "customer_id bigint, user_count bigint"
PRODUCTS = "product_name string, customers bigint, n bigint, active_mrr decimal(28,2), churned_mrr decimal(28,2), cancelled bigint"
SEGMENTS = "segment string, customers bigint, owned_mrr decimal(28,2), n bigint, health bigint, health_rows bigint"


def _newest(name: str, typed: DataFrame) -> DataFrame:
    """The newest silver row of every key of typed rows."""
    if name == "customers":
        return newest_customers(typed)
    return latest_per_key(typed.withColumn("_tie", F.xxhash64(*typed.columns)), [KEY[name]], ["_ingested_at", "_tie"]).drop("_tie")


def _silver(name: str, typed: DataFrame, older: DataFrame) -> DataFrame:
    """The newest silver row of every key of a batch, given the stored rows of these keys."""
    if name == "customers":
        older = older.drop("_dq_status").withColumn("_batch_id", F.lit(None).cast("string"))
    return _newest(name, typed.unionByName(older))


PARSE = {"customers": typed_customers, "subscriptions": to_silver_subscriptions, "users": to_silver_users}
KEY = {"customers": "customer_id", "subscriptions": "subscription_id", "users": "user_id"}


class Layers:
    """Silver, states and gold under one folder."""

    def __init__(self, lab: Lab, root: str):
        spark: SparkSession = lab.spark
        self.spark = spark
        empty = {"customers": newest_customers(typed_customers(bronze_customers(lab))), "subscriptions": to_silver_subscriptions(bronze_subscriptions(lab)), "users": to_silver_users(bronze_users(lab))}
        table = lambda name, schema, keys, bucketed=None: KeyedTable(spark, f"{root}/{name}", schema, keys, bucketed)
        typed = lambda ddl: spark.createDataFrame([], ddl).schema
        self.silver = {name: table(f"silver_{name}", df.schema, [KEY[name]]) for name, df in empty.items()}
        self.owned, self.owns = table("owned", typed(OWNED), ["customer_id"]), table("owns", typed(OWNS), ["customer_id", "product_name"], ["customer_id"])
        self.people, self.products, self.segments = table("people", typed(PEOPLE), ["customer_id"]), table("products", typed(PRODUCTS), ["product_name"]), table("segments", typed(SEGMENTS), ["segment"])
        self.profile = table("customer_360", customer_profile(empty["customers"], self.owned.read().withColumn("products_owned", F.lit("")), self.people.read()).schema, ["customer_id"])

    def _owned_products(self, of: DataFrame) -> DataFrame:
        names = F.array_join(F.array_sort(F.collect_list("product_name")), ", ").alias("products_owned")
        return self.owns.read(of=of).where("n_active > 0").groupBy("customer_id").agg(names)

    def _contributions(self, customers: DataFrame, owned: DataFrame, sign: int) -> DataFrame:
        """What customers add to their segments, times ``sign``."""
        held = customers.select("customer_id", "segment", "health_score").join(owned.select("customer_id", "n", "owned_mrr"), "customer_id", "left")
        rows = F.greatest(F.coalesce("n", F.lit(0)), F.lit(1))
        health = F.when(F.col("health_score").isNotNull(), rows)
        part = {"customers": F.lit(1), "owned_mrr": F.col("owned_mrr"), "n": F.coalesce("n", F.lit(0)), "health": F.col("health_score") * health, "health_rows": health}
        return held.groupBy("segment").agg(*[(sign * F.sum(v)).alias(c) for c, v in part.items()]).na.fill(0, list(part))

    def _changes(self, name: str, arrived: DataFrame | None, batch: int) -> DataFrame:
        """Store the silver rows that a batch moves, and give their signed changes."""
        silver = self.silver[name]
        if arrived is None:
            return self.spark.createDataFrame([], silver.schema).withColumn("sign", F.lit(1))
        typed = PARSE[name](arrived)
        if silver.empty(before=batch):  # every row is new: the stored batch is its changes, and readers take the columns they need from it
            silver.append(_newest(name, typed), batch)
            return silver.of_batch(batch).withColumn("sign", F.lit(1))
        typed = cut_lineage(typed)
        older = cut_lineage(silver.read(of=typed, before=batch))
        changes = cut_lineage(signed_changes(older, _silver(name, typed, older), [KEY[name]]))
        silver.append(changes.where("sign > 0").select(*silver.schema.names), batch)
        return changes

    def apply(self, batch: int, arrived: dict[str, DataFrame]) -> None:
        """Carry bronze rows of some entities through all layers."""
        if self.profile.has(batch):
            return
        changes = {name: self._changes(name, arrived.get(name), batch) for name in self.silver}
        subs = changes["subscriptions"]
        active = F.col("status") == "ACTIVE"
        money = lambda on: F.when(on, F.col("mrr")).otherwise(F.lit(0).cast("decimal(18,2)"))
        gone = F.col("status") == "CANCELLED"
        # read once: what customers, their products and the products move by are sums of these
        moves = cut_lineage(subs.groupBy("customer_id", "product_name").agg(
            signed_sum().alias("n"), signed_sum(F.when(active, 1).otherwise(0)).alias("n_active"), signed_sum(money(active)).alias("active_mrr"),
            signed_sum(money(gone)).alias("churned_mrr"), signed_sum(F.when(gone, 1).otherwise(0)).alias("cancelled"),
        ))
        total = lambda *names: [F.sum(c).alias(c) for c in names]
        owned = cut_lineage(moves.groupBy("customer_id").agg(F.sum("n_active").alias("n"), F.sum("active_mrr").alias("owned_mrr")))
        owns = moves.select("customer_id", "product_name", "n", "n_active")
        people = cut_lineage(changes["users"].groupBy("customer_id").agg(signed_sum().alias("user_count")))
        sums = moves.groupBy("product_name").agg(*total("n", "active_mrr", "churned_mrr", "cancelled"))
        steps = entered(self.owns, owns.drop("n_active"), "n", batch).groupBy("product_name").agg(F.sum("step").alias("customers"))
        product = sums.join(steps.withColumnRenamed("product_name", "_p"), F.col("product_name").eqNullSafe(F.col("_p")), "left").drop("_p").na.fill(0, ["customers"])
        touched = cut_lineage(changes["customers"].select("customer_id").union(owned.select("customer_id")).union(people.select("customer_id")).distinct())

        before = self._contributions(self.silver["customers"].read(of=touched, before=batch), self.owned.read(of=touched, before=batch), -1)
        new = {
            "owned": (self.owned, moved_state(self.owned, owned, batch)), "owns": (self.owns, moved_state(self.owns, owns, batch)),
            "people": (self.people, moved_state(self.people, people, batch)), "products": (self.products, moved_state(self.products, product, batch)),
        }
        for table, rows in new.values():
            table.append(rows, batch)
        customers, held = cut_lineage(self.silver["customers"].read(of=touched)), cut_lineage(self.owned.read(of=touched))
        after = self._contributions(customers, held, 1)
        shift = before.unionByName(after).groupBy("segment").agg(*[F.sum(c).alias(c) for c in before.columns if c != "segment"])
        self.segments.append(moved_state(self.segments, cut_lineage(shift), batch), batch)
        held = held.join(self._owned_products(touched), "customer_id", "left")
        self.profile.append(customer_profile(customers, held, self.people.read(of=touched)), batch)

    def customer_360(self) -> DataFrame:
        return self.profile.read()

    def revenue(self) -> DataFrame:
        """Active revenue per segment from its sums."""
        n = F.col("n")
        return self.segments.read().where("customers > 0").select(
            "segment", F.col("customers").alias("customer_count"), dbl(F.when(n > 0, F.col("owned_mrr"))).alias("total_mrr"), dbl(F.when(n > 0, F.col("owned_mrr") * 12)).alias("total_arr"),
            rounded(safe_div(F.when(n > 0, F.col("owned_mrr")), n), 4).alias("avg_mrr_per_subscription"), n.alias("subscription_count"),
            rounded(safe_div(F.when(F.col("health_rows") > 0, F.col("health")), F.col("health_rows")), 4).alias("avg_health_score"),
        )

    def product_sums(self) -> DataFrame:
        return self.products.read().where("n > 0").select(
            "product_name", F.col("customers").alias("customer_count"), F.col("n").alias("subscription_count"), dbl("active_mrr").alias("active_mrr"), dbl("churned_mrr").alias("churned_mrr"),
            safe_pct(F.col("cancelled"), F.col("n")).alias("churn_rate_pct"),
        )


def later_batch(lab: Lab) -> dict[str, DataFrame]:
    """A batch of all entities: customers that move and arrive, subscriptions that change price, product and status, users that change customer."""
    offset = F.lit(1000000000)
    base = lab.customers(geo=True).select("customer_id", "company_name", "segment", "industry", "mrr", "health_score", F.col("created_date").cast("string").alias("created_date"))
    moved = base.filter("customer_id % 30 = 0").withColumns({"segment": F.lit("FURNITURE"), "health_score": F.lit(55)})
    arrived = base.filter("customer_id % 100 = 0").withColumns({"customer_id": F.col("customer_id") + offset, "company_name": F.concat(F.lit("New Customer "), "customer_id")})
    subs = lab.subscriptions().select(
        "subscription_id", "customer_id", F.col("product_name").alias("product"), F.col("mrr_amount").alias("mrr"), "status", F.col("start_date").cast("string").alias("start_date")
    )
    i = F.col("subscription_id")
    changed = subs.filter("subscription_id % 29 = 0 OR subscription_id % 31 = 0 OR subscription_id % 37 = 0").withColumns({
        "mrr": F.when(i % 29 == 0, F.col("mrr") + 10).otherwise(F.col("mrr")).cast("decimal(18,2)"), "status": F.when(i % 31 == 0, F.lit("Cancelled")).otherwise(F.col("status")),
        "product": F.when(i % 37 == 0, F.lit("Moved")).otherwise(F.col("product")),
    })
    sold = subs.filter("subscription_id % 97 = 0").withColumn("subscription_id", i + offset)
    people = lab.users().select("user_id", "customer_id", "email", "phone", "full_name", "role")
    switched = people.filter("user_id % 41 = 0").withColumn("customer_id", F.col("customer_id") + 1)
    joined = people.filter("user_id % 43 = 0").withColumn("user_id", F.col("user_id") + offset)
    put = lambda df, source: land(df, source, "batch_2024_005", MERGED_AT)
    return {"customers": put(moved.unionByName(arrived), "crm"), "subscriptions": put(changed.unionByName(sold), "billing"), "users": put(switched.unionByName(joined), "identity")}


def refreshed(lab: Lab) -> Layers:
    """Layers after the first load, the later batch, and a repeat of it that changes nothing."""
    layers = Layers(lab, shared_path(lab.spark, "chained"))
    layers.apply(0, {"customers": bronze_customers(lab), "subscriptions": bronze_subscriptions(lab), "users": bronze_users(lab)})
    batch = later_batch(lab)
    for _ in range(2):
        layers.apply(1, batch)
    return layers


def chained_customer_360(lab: Lab) -> DataFrame:
    return refreshed(lab).customer_360()


def chained_revenue(lab: Lab) -> DataFrame:
    return refreshed(lab).revenue()


def chained_products(lab: Lab) -> DataFrame:
    return refreshed(lab).product_sums()


QUERIES = {"chained_customer_360": chained_customer_360, "chained_revenue": chained_revenue, "chained_products": chained_products}
