"""Synthetic subscription-business tables, generated in parallel from seed keys.

Every value is a function of its row's key (see functions/picks.py), so a
generator is one narrow projection over the seeds at any size, repeatable row
by row. The registered queries take the keys of the customer table as seeds;
``seeds(spark, n)`` makes a plain range of any length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.dates import day
from tallyloom.functions.picks import below, between, pick
from tallyloom.operators.ordered import dense_ids
from tallyloom.plans.medallion import land
from tallyloom.sources.lab import EVENTS_AS_OF, Lab

PREFIXES = ["Amber", "Birch", "Cobalt", "Delta", "Ember", "Fjord", "Granite", "Harvest", "Indigo", "Juniper"]
MIDDLES = ["Advisory", "Asset", "Equity", "Estate", "Income", "Trustee"]
SUFFIXES = ["Associates", "Company", "Group", "House", "Partners"]
SEGMENTS = ["Enterprise", "Mid-Market", "SMB"]
INDUSTRIES = ["Advisor", "Bank", "Broker", "Family Office", "Insurance", "Trust"]
STATES = ["CA", "CO", "FL", "GA", "IL", "MA", "NY", "OH", "TX", "WA"]
FIRST = ["Ada", "Ben", "Cora", "Dan", "Eva", "Finn", "Gia", "Hugo", "Ida", "Jon"]
LAST = ["Abel", "Berg", "Cruz", "Dahl", "Ekman", "Fox", "Grant", "Holt"]
ROLES = ["Editor", "Observer", "Owner", "Planner", "Reviewer"]
PRODUCTS = ["Archive", "Campaigns", "Insights", "Messaging", "Sites", "Social"]
TIERS = ["Starter", "Professional", "Enterprise"]
STATUSES = ["Active"] * 7 + ["Cancelled", "Paused"]  # weights by repetition
PRAISE = ["Love the templates, great results.", "Excellent support, quick and helpful.", "The reports are outstanding."]
NEUTRAL = ["Good overall, the scheduler could be simpler.", "Does what we need.", "Useful, with a few minor bugs."]
BLAME = ["Too expensive for what it does.", "Email delivery failed twice and support was slow.", "The app crashes and reports are confusing."]
CHANNELS = ["Cold Call", "Newsletter", "Podcast", "Reseller", "Search Ad"]
CATEGORIES = ["Access", "Data Import", "Delivery", "Invoice", "Outage", "Report Layout"]
PIPELINE = [("Lead In", 5), ("Scoping", 20), ("Pilot", 45), ("Contract Sent", 85), ("Won", 100), ("Lost", 0)]  # stage and chance in percent
DEALS = ["First Contract"] * 7 + ["Extension"] * 3


def seeds(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(n).withColumnRenamed("id", "k")


def _lab_seeds(lab: Lab) -> DataFrame:
    """The keys of the customer table, dealt over all tasks: a few megabytes of keys, one split of a scan, become hundreds of rows each."""
    spark = lab.spark
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return lab.raw("customer").select(F.col("c_custkey").alias("k")).repartition(tasks)


def _days_ago(days: Column) -> Column:
    return F.date_sub(day(EVENTS_AS_OF), days)


def _padded(prefix: str, number: Column, width: int) -> Column:
    """Zeros fill up short numbers; long ones stay whole."""
    digits = number.cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(digits) < width, F.lpad(digits, width, "0")).otherwise(digits))


def _key(*parts: Column) -> Column:
    """A child key from a parent key and child numbers of any size."""
    return F.concat_ws("-", *[p.cast("string") for p in parts])


def _named(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(prefix), key)


# -- compact star ---------------------------------------------------------------


def customers(seed: DataFrame) -> DataFrame:
    k, segment = F.col("k"), F.col("segment")
    base = seed.withColumn("segment", pick(k, 4, SEGMENTS))
    spread = between(k, 9, 0, 7999)
    mrr = F.when(segment == "Enterprise", 2000 + spread).when(segment == "Mid-Market", 500 + spread % 2000).otherwise(99 + spread % 701)
    return base.select(
        "k", _padded("C", k, 9).alias("customer_id"), F.concat_ws(" ", pick(k, 1, PREFIXES), pick(k, 2, MIDDLES), pick(k, 3, SUFFIXES)).alias("company_name"),
        "segment", pick(k, 5, INDUSTRIES).alias("industry"), pick(k, 6, STATES).alias("state"), mrr.cast("int").alias("mrr"), below(k, 7, 101).alias("health_score"),
        _days_ago(between(k, 8, 1, 1500)).alias("created_date"),
    )


def users(people: DataFrame) -> DataFrame:
    """Two or three users per customer, with dense ids in customer order."""
    expanded = people.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(2) + below(F.col("k"), 20, 2))))
    u = _key(F.col("k"), F.col("n"))
    first, last = pick(u, 21, FIRST), pick(u, 22, LAST)
    phone = F.concat(F.lit("("), between(u, 24, 100, 999), F.lit(") "), between(u, 25, 100, 999), F.lit("-"), between(u, 26, 1000, 9999))
    domain = F.left(F.lower(F.replace(F.col("company_name"), F.lit(" "), F.lit(""))), F.lit(15))
    rows = expanded.select(
        "customer_id", "n", F.concat(F.lower(first), F.lit("."), F.lower(last), F.lit("@"), domain, F.lit(".com")).alias("email"), phone.alias("phone"),
        F.concat_ws(" ", first, last).alias("full_name"), pick(u, 23, ROLES).alias("role"),
    )
    return dense_ids(rows, [F.col("customer_id"), F.col("n")], "rn").withColumn("user_id", _padded("U", F.col("rn"), 9)).drop("rn", "n")


def subscriptions(people: DataFrame) -> DataFrame:
    expanded = people.withColumn("n", F.explode(F.array(F.lit(1), F.lit(2))))
    s, segment = _key(F.col("k"), F.col("n")), F.col("segment")
    spread = between(s, 33, 0, 2499)
    mrr = F.when(segment == "Enterprise", 500 + spread).when(segment == "Mid-Market", 200 + spread % 800).otherwise(50 + spread % 350)
    return expanded.select(
        _named("S", s).alias("subscription_id"), "customer_id", pick(s, 31, PRODUCTS).alias("product"), mrr.cast("int").alias("mrr"),
        pick(s, 32, STATUSES).alias("status"), F.date_add("created_date", between(s, 34, 0, 29)).alias("start_date"),
    )


def feedback(people: DataFrame) -> DataFrame:
    """About half of the customers answer; the wording follows the score."""
    k, score = F.col("k"), F.col("nps_score")
    answered = people.filter(below(k, 40, 100) <= 50).withColumn("nps_score", between(k, 41, 1, 10))
    text = F.when(score >= 9, pick(k, 43, PRAISE)).when(score >= 7, pick(k, 43, NEUTRAL)).otherwise(pick(k, 43, BLAME))
    return answered.select(_padded("F", k, 9).alias("feedback_id"), "customer_id", "nps_score", text.alias("feedback_text"), _days_ago(between(k, 42, 1, 365)).alias("submitted_date"))


# -- full star ---------------------------------------------------------------------


def star_customers(seed: DataFrame) -> DataFrame:
    k, segment, draw = F.col("k"), F.col("segment"), below(F.col("k"), 53, 100)
    status = F.when(draw < 78, "Active").when(draw < 88, "Churned").when(draw < 94, "Paused").otherwise("Trial")
    band = F.when(segment == "SMB", pick(k, 55, ["1-5", "6-20"])).when(segment == "Mid-Market", pick(k, 55, ["21-50", "51-100"])).otherwise("100+")
    return customers(seed).select(
        "k", "customer_id", "company_name", "segment", "industry", "state", "created_date", pick(k, 51, CHANNELS).alias("acquisition_channel"),
        F.concat(F.lit("Desk "), below(k, 52, 10)).alias("csm_owner"), status.alias("account_status"), (below(k, 54, 100) < 15).alias("is_strategic_account"), band.alias("employee_count_band"),
    )


def star_users(accounts: DataFrame) -> DataFrame:
    most = F.when(F.col("segment") == "SMB", between(F.col("k"), 60, 2, 5)).when(F.col("segment") == "Mid-Market", between(F.col("k"), 60, 4, 8)).otherwise(between(F.col("k"), 60, 6, 15))
    expanded = accounts.withColumn("n", F.explode(F.sequence(F.lit(1), most)))
    u, live = _key(F.col("k"), F.col("n")), F.col("account_status") == "Active"
    return expanded.select(
        u.alias("u"), F.col("k"), _named("USER-", u).alias("user_id"), "customer_id", pick(u, 61, FIRST).alias("first_name"), pick(u, 62, LAST).alias("last_name"), pick(u, 63, ROLES).alias("role"),
        F.date_add("created_date", between(u, 64, 0, 365)).alias("created_date"), F.when(live, _days_ago(between(u, 65, 0, 30))).otherwise(_days_ago(between(u, 65, 30, 180))).alias("last_login_date"),
        between(u, 66, 5, 500).alias("login_count"), (F.col("n") == 1).alias("is_primary_contact"),
        F.when(live & (below(u, 67, 100) < 92), "Active").otherwise("Inactive").alias("user_status"), (below(u, 68, 100) < 70).alias("mfa_enabled"),
    )


def star_subscriptions(accounts: DataFrame) -> DataFrame:
    count = F.when(F.col("segment") == "Enterprise", 4).when(F.col("segment") == "Mid-Market", 3).otherwise(2)
    expanded = accounts.withColumn("n", F.explode(F.sequence(F.lit(1), count)))
    s, status = _key(F.col("k"), F.col("n")), F.col("account_status")
    off = F.when(F.col("segment") == "Enterprise", between(s, 73, 10, 25)).otherwise(0)
    price = between(s, 72, 49, 899)
    start = F.date_add("created_date", between(s, 74, 0, 90))
    return expanded.select(
        _named("SUB-", s).alias("subscription_id"), "customer_id", F.get(F.array(*map(F.lit, PRODUCTS)), (below(F.col("k"), 71, 6) + F.col("n")) % 6).alias("product_name"),
        pick(s, 75, TIERS).alias("plan_tier"), F.when(below(s, 76, 100) < 70, "Annual").otherwise("Monthly").alias("billing_frequency"), start.alias("start_date"),
        F.when(status == "Churned", F.add_months(start, between(s, 77, 3, 24))).alias("end_date"),
        F.when(status == "Churned", "Cancelled").when(status == "Paused", "Pending").otherwise("Active").alias("status"),
        (price * (100 - off)).alias("mrr_cents"), (price * (100 - off) * 12).alias("arr_cents"), off.alias("discount_percent"),
    )


def star_usage(members: DataFrame, days: int = 90) -> DataFrame:
    """Active users on about seven of ten days; fewer posts at weekends, more mail mid-week."""
    calendar = members.filter("user_status = 'Active'").withColumn("d", F.explode(F.sequence(F.lit(0), F.lit(days - 1))))
    e, date = _key(F.col("u"), F.col("d")), _days_ago(F.col("d"))
    weekday = F.dayofweek(date)  # Sunday = 1
    return calendar.filter(below(e, 80, 10) < 7).select(
        date.alias("usage_date"), "customer_id", "user_id", F.when(weekday.isin(3, 5), between(e, 81, 0, 50)).otherwise(between(e, 81, 0, 20)).alias("emails_sent"),
        F.when(weekday.isin(1, 7), 0).otherwise(between(e, 82, 0, 8)).alias("social_posts_published"), between(e, 83, 1, 10).alias("total_logins"), between(e, 84, 5, 120).alias("session_duration_minutes"),
    )


def star_health(accounts: DataFrame, weeks: int = 12) -> DataFrame:
    weekly = accounts.filter(F.col("account_status").isin("Active", "Paused")).withColumn("w", F.explode(F.sequence(F.lit(0), F.lit(weeks - 1))))
    h = _key(F.col("k"), F.col("w"))
    scored = weekly.select(
        "customer_id", F.date_sub(F.trunc(day(EVENTS_AS_OF), "week"), F.col("w") * 7).alias("snapshot_date"), between(h, 91, 40, 100).alias("usage_score"), between(h, 92, 30, 100).alias("engagement_score"),
        between(h, 93, 50, 100).alias("support_score"), between(h, 94, 60, 100).alias("payment_score"), between(h, 95, 20, 100).alias("expansion_score"), pick(h, 96, ["Improving", "Stable", "Declining"]).alias("health_trend"),
    )
    total = F.floor((F.col("usage_score") * 25 + F.col("engagement_score") * 20 + F.col("support_score") * 20 + F.col("payment_score") * 20 + F.col("expansion_score") * 15 + 50) / 100).cast("int")
    score = F.col("overall_health_score")
    risk = F.when(score >= 80, "Low").when(score >= 60, "Medium").when(score >= 40, "High").otherwise("Critical")
    return scored.withColumn("overall_health_score", total).withColumn("churn_risk", risk)


def star_nps(members: DataFrame) -> DataFrame:
    u, score = F.col("u"), F.col("nps_score")
    asked = members.filter(F.col("is_primary_contact") & (below(u, 100, 10) < 3)).withColumn("nps_score", between(u, 101, 0, 10))
    category = F.when(score <= 6, "Detractor").when(score <= 8, "Passive").otherwise("Promoter")
    text = F.when(below(u, 103, 10) < 4, F.lit(None)).otherwise(pick(u, 104, PRAISE + NEUTRAL + BLAME))
    return asked.select(_named("NPS-", u).alias("response_id"), "customer_id", "user_id", _days_ago(between(u, 102, 0, 365)).alias("survey_date"), "nps_score", category.alias("nps_category"), text.alias("feedback_text"))


def star_tickets(members: DataFrame) -> DataFrame:
    u, draw = F.col("u"), below(F.col("u"), 112, 100)
    status = F.when(draw < 58, "Resolved").when(draw < 74, "Closed").when(draw < 86, "In Progress").when(draw < 93, "Waiting on Customer").otherwise("Open")
    return members.filter(below(u, 110, 10) < 4).select(
        _named("TKT-", u).alias("ticket_id"), "customer_id", "user_id", _days_ago(between(u, 111, 0, 365)).alias("created_date"), pick(u, 113, CATEGORIES).alias("category"),
        pick(u, 114, ["Medium"] * 5 + ["Low"] * 3 + ["High", "Urgent"]).alias("priority"), status.alias("status"), between(u, 115, 1, 72).alias("resolution_time_hours"),
        between(u, 116, 1, 5).alias("csat_score"), (below(u, 117, 100) < 92).alias("sla_met"), F.concat(F.lit("Question about "), F.lower(pick(u, 113, CATEGORIES))).alias("ticket_summary"),
    )


def star_leads(seed: DataFrame) -> DataFrame:
    k, draw = F.col("k"), below(F.col("k"), 122, 100)
    status = F.when(draw < 24, "New").when(draw < 42, "Contacted").when(draw < 67, "Qualified").when(draw < 81, "Converted").otherwise("Unqualified")
    return seed.select(
        "k", _padded("LEAD-", k, 9).alias("lead_id"), F.concat_ws(" ", pick(k, 120, PREFIXES), pick(k, 121, SUFFIXES)).alias("company_name"), pick(k, 123, CHANNELS).alias("lead_source"),
        _days_ago(between(k, 124, 0, 365)).alias("created_date"), status.alias("lead_status"), F.when(below(k, 125, 10) < 6, _days_ago(between(k, 126, 0, 365))).alias("mql_date"),
    )


def star_opportunities(leads: DataFrame) -> DataFrame:
    k, at = F.col("k"), below(F.col("k"), 131, len(PIPELINE))
    open_leads = leads.filter(F.col("lead_status").isin("Qualified", "Converted") & (below(k, 130, 10) < 8))
    stage = F.get(F.array(*[F.lit(s) for s, _ in PIPELINE]), at)
    return open_leads.select(
        _padded("OPP-", k, 9).alias("opportunity_id"), "lead_id", F.concat(F.col("company_name"), F.lit(" - "), pick(k, 132, DEALS)).alias("opportunity_name"), stage.alias("stage"),
        F.get(F.array(*[F.lit(p) for _, p in PIPELINE]), at).alias("probability"), between(k, 133, 5000, 100000).alias("amount"), F.date_add("created_date", between(k, 134, 30, 120)).alias("close_date"),
        F.when(stage.isin("Won", "Lost"), F.date_add("created_date", between(k, 135, 30, 90))).alias("actual_close_date"),
    )


def staging_batch(seed: DataFrame) -> DataFrame:
    """New raw customers for a staging table, packed as the bronze layer stores them."""
    k = F.col("k")
    rows = seed.select(
        _padded("N", k, 9).alias("customer_id"), F.concat(F.lit("New Customer "), k).alias("company_name"), F.get(F.array(*map(F.lit, SEGMENTS)), (k % 3).cast("int")).alias("segment"),
        (1000 + k * 123 % 5000).alias("mrr"), (50 + k * 7 % 50).alias("health_score"), F.lit(EVENTS_AS_OF).alias("created_date"),
    )
    return land(rows, "monthly_batch_load", "batch_2024_004", f"{EVENTS_AS_OF} 00:00:00")


def _from(build, *steps):
    def run(lab: Lab) -> DataFrame:
        df = _lab_seeds(lab)
        for step in (*steps, build):
            df = step(df)
        return df.drop("k", "u")

    return run


def gen_batch(lab: Lab) -> DataFrame:
    raw = staging_batch(_lab_seeds(lab))
    return raw.select(F.try_variant_get("_raw_data", "$.CUSTOMER_ID", "string").alias("customer_id"), F.try_variant_get("_raw_data", "$.SEGMENT", "string").alias("segment"), F.try_variant_get("_raw_data", "$.MRR", "bigint").alias("mrr"), "_source_system", "_batch_id")


QUERIES = {
    "gen_customers": _from(customers), "gen_users": _from(users, customers), "gen_subscriptions": _from(subscriptions, customers), "gen_feedback": _from(feedback, customers),
    "gen_star_customers": _from(star_customers), "gen_star_users": _from(star_users, star_customers), "gen_star_subscriptions": _from(star_subscriptions, star_customers),
    "gen_star_usage": _from(star_usage, star_customers, star_users), "gen_star_health": _from(star_health, star_customers), "gen_star_nps": _from(star_nps, star_customers, star_users),
    "gen_star_tickets": _from(star_tickets, star_customers, star_users), "gen_star_leads": _from(star_leads), "gen_star_opportunities": _from(star_opportunities, star_leads), "gen_batch": gen_batch,
}
