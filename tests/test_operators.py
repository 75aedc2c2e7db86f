"""Operators on literal frames."""

import datetime as dt
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyloom import labels
from tallyloom.functions import dates, masks, numbers, picks
from tallyloom.operators.access import Policy, governed, mask_by_tags, rows_by_owner, rows_by_status, tag_columns
from tallyloom.operators.changes import change_feed, merge_additive, merge_dimension, revenue_movements
from tallyloom.operators.latest import latest_per_key
from tallyloom.operators.ordered import dense_ids, group_median, ordered_scan, ranged_rows
from tallyloom.operators.quality import column_profile, name_category, repeated_keys
from tallyloom.operators.semantic import Named, SemanticModel, query_metrics, semantic_view
from tallyloom.operators.series import anomalies, forecast
from tallyloom.plans import finops, generators, medallion
from tallyloom.sources import snapshots, tables
from tallyloom.sources.lab import Lab
from tallyloom.sources.shared import shared_path


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# -- dates, numbers, picks --------------------------------------------------


def test_boundary_differences(spark):
    df = spark.sql("SELECT DATE'2024-01-31' a, DATE'2024-02-01' b, TIMESTAMP_NTZ'2024-01-01 00:00:59' c, TIMESTAMP_NTZ'2024-01-01 00:01:01' d")
    got = df.select(
        dates.month_diff(F.col("a"), F.col("b")), dates.year_diff(F.col("a"), F.col("b")), dates.day_diff(F.col("a"), F.col("b")),
        dates.minute_diff(F.col("c"), F.col("d")), dates.second_diff(F.col("c"), F.col("d")),
    ).first()
    assert tuple(got) == (1, 0, 1, 1, 2)


def test_safe_percent_and_bytes(spark):
    got = spark.range(1).select(numbers.safe_pct(F.lit(1), F.lit(0)), numbers.safe_pct(F.lit(1), F.lit(3)), numbers.bytes_as(F.lit(1024**3), 3)).first()
    assert tuple(got) == (None, 33.33, 1.0)


def test_picks_are_even_and_repeatable(spark):
    df = spark.range(20000).select(picks.below(F.col("id"), 5, 10).alias("b"), picks.pick(F.col("id"), 6, ["x"] * 7 + ["y"]).alias("p"))
    counts = {r["b"]: r["count"] for r in df.groupBy("b").count().collect()}
    assert set(counts) == set(range(10)) and max(counts.values()) < 2300 and min(counts.values()) > 1700
    share = df.filter("p = 'x'").count() / 20000
    assert abs(share - 7 / 8) < 0.02
    assert df.exceptAll(df).count() == 0


@pytest.mark.parametrize("other", [2, 7, 51, 53, 110])
def test_draws_of_one_key_are_independent(spark, other):
    pairs = spark.range(40000).select(picks.below(F.col("id"), 1, 10).alias("a"), picks.below(F.col("id"), other, 10).alias("b"))
    counts = [r["count"] for r in pairs.groupBy("a", "b").count().collect()]
    assert len(counts) == 100 and min(counts) > 320 and max(counts) < 480


def test_long_numbers_keep_their_digits(spark):
    k = spark.createDataFrame([(7,), (10**9,), (10**9 + 1,), (12 * 10**12,)], "k long")
    people = generators.customers(k)
    assert [r.customer_id for r in people.orderBy("k").collect()] == ["C000000007", "C1000000000", "C1000000001", "C12000000000000"]
    for rows, key in ((generators.users(people), "user_id"), (generators.subscriptions(people), "subscription_id")):
        assert rows.select(key).distinct().count() == rows.count()
    days = generators.star_usage(generators.star_users(generators.star_customers(generators.seeds(spark, 3))).limit(4), days=1500)
    assert days.groupBy("user_id", "usage_date").count().where("count > 1").isEmpty()


def test_a_key_that_changes_twice(spark):
    dim = spark.sql("SELECT 1 sk, 1 k, 'A' s, true is_current, DATE'2024-01-01' effective_from, CAST(NULL AS DATE) effective_to")
    at = F.lit("2024-02-01").cast("date")
    feed = lambda *r: spark.createDataFrame(list(r), "k int, s string, _action string, _is_update boolean, seq int")
    merged = lambda f, **o: sorted((r.sk, r.k, r.s, r.is_current) for r in merge_dimension(dim, f, "k", ["s"], at, "sk", order=["seq"], **o).collect())
    twice = feed((1, "B", "INSERT", False, 1), (1, "C", "INSERT", False, 2), (2, "X", "INSERT", False, 1))
    assert merged(twice) == [(1, 1, "A", False), (2, 1, "C", True), (3, 2, "X", True)]
    pairs = feed((1, "A", "DELETE", True, 1), (1, "B", "INSERT", True, 1), (1, "B", "DELETE", True, 2), (1, "A", "INSERT", True, 2))
    assert merged(pairs) == [(1, 1, "A", True)]
    back = feed((1, "A", "DELETE", False, 1), (1, "D", "INSERT", False, 2))
    assert merged(back, close_deleted=True) == [(1, 1, "A", False), (2, 1, "D", True)]
    gone = feed((1, "B", "INSERT", True, 1), (1, "B", "DELETE", False, 2))
    assert merged(gone, close_deleted=True) == [(1, 1, "A", False)]
    with pytest.raises(Exception, match="changes twice"):
        merge_dimension(dim, twice, "k", ["s"], at, "sk").collect()


# -- ordered scans --------------------------------------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(7)
    data = [("hot" if rng.random() < 0.7 else f"g{rng.randrange(5)}", rng.choice([None, 1, 2, 2, 2, 5, 9]), i, rng.choice([None, None, None, i])) for i in range(3000)]
    return spark.createDataFrame(data, "g string, v int, id int, x int").repartition(7)


def test_ordered_scan_equals_window(spark, skewed):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        order = [F.col("v").desc_nulls_last(), F.col("id")]
        got = ordered_scan(skewed, ["g"], order, row_number="rn", group_rows="n", running={"s": "id", "t": "x"}, lag={"p": "v"}, lead={"q": "v"})
        w = Window.partitionBy("g").orderBy(*order)
        want = skewed.select(
            "g", "v", "id", "x", F.row_number().over(w).cast("bigint").alias("rn"), F.count("*").over(Window.partitionBy("g")).alias("n"),
            F.sum("id").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("s"), F.sum("x").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("t"), F.lag("v").over(w).alias("p"), F.lead("v").over(w).alias("q"),
        )
        assert got.columns == want.columns
        assert rows(got) == rows(want)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_one_hot_group_and_value_spread_over_partitions(spark):
    """All rows in one group with one value: the unique last key still splits them evenly."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        hot = spark.range(40000).select(F.lit("hot").alias("g"), F.lit(1).alias("v"), "id")
        sizes = [r["count"] for r in ranged_rows(hot, ["g"], [F.col("v"), F.col("id")]).groupBy("_part").count().collect()]
        assert len(sizes) == 8 and max(sizes) < 2 * 40000 / 8
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_dense_ids(spark, skewed):
    got = dense_ids(skewed, [F.col("g"), F.col("id").desc()], "k").select("k").collect()
    assert sorted(r["k"] for r in got) == list(range(1, 3001))


def test_group_median(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 4, 2), ("a", 2, 3), ("b", 5, 4), ("b", 8, 5), ("c", None, 6)], "g string, v int, id int")
    assert rows(group_median(df, ["g"], "v", "id", "m")) == [("a", 2.0), ("b", 6.5)]


def test_latest_per_key_breaks_ties(spark):
    df = spark.createDataFrame([(1, 5, 1, "a"), (1, 5, 2, "b"), (1, 4, 9, "c"), (2, 1, 1, None)], "k int, t int, id int, v string")
    assert rows(latest_per_key(df, ["k"], ["t", "id"])) == [(1, 5, 2, "b"), (2, 1, 1, None)]


# -- table writes -----------------------------------------------------------------


def test_write_append_update_delete(spark):
    path = shared_path(spark, "t")
    t = tables.write_table(spark.createDataFrame([(1, "a"), (2, None)], "k int, v string"), path)
    t = tables.append_rows(tables.literal_rows(spark, [("c", 3)], "v string, k int"), path)
    assert rows(t) == [(1, "a"), (2, None), (3, "c")]
    assert rows(tables.update_where(t, F.col("v") == "a", {"v": F.lit("z")})) == [(1, "z"), (2, None), (3, "c")]
    assert rows(tables.delete_where(t, F.col("v") == "a")) == [(2, None), (3, "c")]
    assert rows(tables.delete_matching(t, spark.createDataFrame([(3,), (3,)], "k int"), ["k"])) == [(1, "a"), (2, None)]
    assert rows(tables.insert_if_absent(t, spark.createDataFrame([(3, "x"), (4, "y")], "k int, v string"), ["k"])) == [(4, "y")]
    tables.write_table(spark.createDataFrame([(9, "n")], "k int, v string"), path)
    assert rows(spark.read.parquet(path)) == [(9, "n")]


def test_union_padded_and_counts(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([("q",)], "y string")
    assert rows(tables.union_padded(a, b)) == [(1, None), (None, "q")]
    assert rows(tables.row_counts({"a": a, "b": b})) == [("a", 1), ("b", 1)]


# -- changes and merges -------------------------------------------------------------


@pytest.fixture(scope="module")
def versions(spark):
    old = spark.createDataFrame([(1, "A", None), (2, "B", 1), (3, "C", 2)], "k int, s string, n int")
    new = spark.createDataFrame([(1, "A", None), (2, "X", 1), (4, "D", 3)], "k int, s string, n int")
    return old, new


def test_change_feed(versions):
    got = change_feed(*versions, ["k"])
    assert rows(got.drop("_row_id")) == sorted([
        (2, "B", 1, "DELETE", True), (2, "X", 1, "INSERT", True), (3, "C", 2, "DELETE", False), (4, "D", 3, "INSERT", False),
    ], key=repr)
    assert len({r["_row_id"] for r in got.filter("k = 2").collect()}) == 1


def test_change_feed_empty_when_equal(versions):
    assert change_feed(versions[0], versions[0], ["k"]).count() == 0


def test_change_feed_rejects_repeated_keys(versions):
    old, new = versions
    with pytest.raises(PySparkException, match="duplicate key"):
        change_feed(old.unionByName(old), new, ["k"]).collect()


def test_dimension_merge_modes(spark):
    dim = spark.sql(
        "SELECT 10 sk, 1 k, 'A' s, true is_current, DATE'2024-01-01' effective_from, CAST(NULL AS DATE) effective_to UNION ALL SELECT 11, 2, 'B', true, DATE'2024-01-01', NULL "
        "UNION ALL SELECT 9, 2, 'old', false, DATE'2023-01-01', DATE'2024-01-01'"
    )
    old, new = spark.createDataFrame([(1, "A"), (2, "B")], "k int, s string"), spark.createDataFrame([(2, "X"), (3, "N")], "k int, s string")
    feed, at, day = change_feed(old, new, ["k"]), F.lit("2024-02-01").cast("date"), dt.date
    base = [(9, 2, "old", False, day(2023, 1, 1), day(2024, 1, 1)), (11, 2, "B", False, day(2024, 1, 1), day(2024, 2, 1))]
    stays = (10, 1, "A", True, day(2024, 1, 1), None)
    assert rows(merge_dimension(dim, feed, "k", ["s"], at, "sk")) == sorted(base + [stays, (12, 2, "X", True, day(2024, 2, 1), None), (13, 3, "N", True, day(2024, 2, 1), None)], key=repr)
    assert rows(merge_dimension(dim, feed, "k", ["s"], at, "sk", mode="as_written")) == sorted(base + [stays, (12, 3, "N", True, day(2024, 2, 1), None)], key=repr)
    closed = merge_dimension(dim, feed, "k", ["s"], at, "sk", close_deleted=True).filter("k = 1").collect()
    assert [(r["is_current"], r["effective_to"]) for r in closed] == [(False, day(2024, 2, 1))]


def test_additive_merge(spark):
    target = spark.createDataFrame([("c", 1, 10, 4)], "k string, m int, sent int, users int")
    batch = spark.createDataFrame([("c", 1, 5, 2), ("c", 2, 7, 3)], "k string, m int, sent int, users int")
    assert rows(merge_additive(target, batch, ["k", "m"], ["sent"], ["users"])) == [("c", 1, 15, 2), ("c", 2, 7, 3)]


def test_movements(spark):
    schema = "subscription_id int, customer_id int, product_name string, mrr_amount int"
    old = spark.createDataFrame([(1, 1, "p", 10), (2, 1, "p", 10), (3, 1, "p", 10), (4, 1, "p", 10)], schema)
    new = spark.createDataFrame([(1, 1, "p", 15), (2, 1, "p", 5), (4, 1, "p", 10), (5, 1, "p", 8)], schema)
    got = revenue_movements(old, new, F.lit("2024-01-01").cast("date")).select("subscription_id", "movement_type", "mrr_change")
    assert rows(got) == [(1, "EXPANSION", 5), (2, "CONTRACTION", -5), (3, "CHURN", -10), (5, "NEW", 8)]


# -- snapshots -----------------------------------------------------------------------


def test_snapshots(spark):
    root = shared_path(spark, "snap")
    one, two = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(1,)], "k int")
    snapshots.write_snapshot(one, root, "2024-01-01 00:00:00")
    snapshots.write_snapshot(two, root, "2024-01-01 01:00:00")
    assert rows(snapshots.read_as_of(spark, root)) == [(1,)]
    assert rows(snapshots.read_as_of(spark, root, at="2024-01-01 00:30:00")) == [(1,), (2,)]
    assert rows(snapshots.read_as_of(spark, root, offset_seconds=60)) == [(1,), (2,)]
    with pytest.raises(LookupError):
        snapshots.read_as_of(spark, root, at="2023-01-01 00:00:00")
    live = snapshots.publish(spark, root, one, "2024-01-02 00:00:00")
    assert live.count() == 2 and snapshots.read_as_of(spark, root, at="2024-01-01 12:00:00").count() == 1
    files = snapshots.read_as_of(spark, root, at="2024-01-01 00:30:00").inputFiles()
    assert len({f.split("/data/")[1].split("/")[0] for f in files}) == 1
    snapshots.write_snapshot(two, root, "2024-01-02 00:00:00")  # of one time the last counts
    assert rows(snapshots.read_as_of(spark, root)) == [(1,)]


# -- medallion ---------------------------------------------------------------------------


def test_silver_rules_and_propagation(spark):
    schema = "customer_id int, company_name string, segment string, industry string, mrr decimal(18,2), health_score int, created_date string"
    def load(data, batch, at):
        return medallion.land(spark.createDataFrame(data, schema), "crm", batch, at)
    D = __import__("decimal").Decimal
    first = load([(1, "A", "smb", "x", D("1.00"), 101, "2022-01-15"), (2, "B", "smb", "x", D("2.00"), None, "2022-13-01"), (3, "C", "smb", "x", D("3.00"), -1, None), (4, "D", "smb", "x", None, 50, "2022-01-01")], "b1", "2024-01-01 00:00:00")
    silver = medallion.to_silver_customers(first)
    assert [r["_dq_status"] for r in silver.orderBy("customer_id").collect()] == ["INVALID_HEALTH_SCORE"] * 3 + ["VALID"]
    assert [r["created_date"] for r in silver.orderBy("customer_id").collect()] == [dt.date(2022, 1, 15), None, None, dt.date(2022, 1, 1)]
    second = first.unionByName(load([(1, "A", "smb", "x", D("9.00"), 87, "2022-01-15"), (5, "E", "smb", "x", D("5.00"), 91, "2024-01-01")], "b2", "2024-01-02 00:00:00"))
    after = medallion.to_silver_customers(second)
    assert after.count() == 5 and [float(r["mrr"]) for r in after.filter("customer_id = 1").collect()] == [9.0]
    path = shared_path(spark, "bronze")
    second.write.parquet(path)
    assert rows(medallion.to_silver_customers(spark.read.parquet(path))) == rows(after)


# -- governance -----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def person(spark):
    return spark.createDataFrame([("Mira Okafor", "mira.okafor@northquay.example", "(412) 555-0198", 1234.0)], "full_name string, email string, phone string, mrr double")


def test_short_masks(person):
    policy = Policy(masks={"full_name": masks.short_name_mask, "email": masks.short_email_mask, "phone": masks.short_phone_mask})
    assert tuple(governed(person, policy, "admin").first())[:3] == ("Mira Okafor", "mira.okafor@northquay.example", "(412) 555-0198")
    assert tuple(governed(person, policy, "analyst").first())[:3] == ("M. Okafor", "****@northquay.example", "(***) ***-0198")


@pytest.mark.parametrize("role,want", [
    ("compliance", ("Mira Okafor", "mira.okafor@northquay.example", "(412) 555-0198", 1234.0)),
    ("engineer", ("M***", "****@northquay.example", "(***) ***-0198", 1234.0)),
    ("viewer", ("***", "****@****.***", "(***) ***-****", 1200.0)),
    ("nobody", ("***", "****@****.***", "(***) ***-****", None)),
])
def test_tiered_masks(person, role, want):
    policy = Policy(masks={"full_name": masks.name_mask, "email": masks.email_mask, "phone": masks.phone_mask, "mrr": masks.amount_mask})
    assert tuple(governed(person, policy, role).first()) == want


def test_tags(person):
    tagged = tag_columns(person, {"email": "DIRECT_IDENTIFIER", "full_name": "QUASI_IDENTIFIER"})
    assert tuple(mask_by_tags(tagged, "analyst").first())[:3] == ("M***", "***REDACTED***", "(412) 555-0198")
    assert mask_by_tags(tagged, "admin").first()["email"] == "mira.okafor@northquay.example"


def test_row_policies(spark):
    df = spark.createDataFrame([(1, "Active", "Ann"), (2, "Churned", "Ann"), (3, "Trial", "Bob")], "k int, account_status string, csm_owner string")
    seen = lambda policy, role: [r["k"] for r in governed(df, policy, role).orderBy("k").collect()]
    status = Policy(rows=rows_by_status())
    assert (seen(status, "admin"), seen(status, "viewer"), seen(status, "guest")) == ([1, 2, 3], [1, 3], [])
    mapping = spark.createDataFrame([("u1", "Ann"), ("u2", None)], "user string, csm_name string")
    owner = lambda user: Policy(rows=rows_by_owner(mapping, user))
    assert (seen(owner("u1"), "analyst"), seen(owner("u2"), "viewer"), seen(owner("u3"), "analyst"), seen(owner("u3"), "engineer")) == ([1, 2], [1, 2, 3], [], [1, 2, 3])


def test_filter_before_mask_and_pushdown(spark):
    path = shared_path(spark, "gov")
    spark.createDataFrame([("Active", "a"), ("Churned", "b")], "account_status string, v string").write.parquet(path)
    hide = lambda c, role: F.lit("***")
    df = governed(spark.read.parquet(path), Policy(masks={"account_status": hide}, rows=rows_by_status()), "analyst")
    assert rows(df) == [("***", "a")]
    assert "PushedFilters: [In(account_status" in df._jdf.queryExecution().toString()


def test_profiles(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "a")], "k int, s string")
    assert rows(column_profile(df)) == [("k", 3, 0, 2, 1), ("s", 3, 1, 1, 1)]
    assert rows(repeated_keys(df, ["k"])) == [(1, 2)]
    assert [name_category(c) for c in ["email", "home_phone", "last_name", "ssn", "mrr"]] == ["EMAIL", "PHONE", "NAME", "SSN", "OTHER"]


# -- cost and series ---------------------------------------------------------------------------


def test_anomaly_levels(spark):
    flat = [("w1", i, 5.0) for i in range(10)]
    spiky = [("w2", i, 10.0 + (i % 2)) for i in range(30)] + [("w2", 30, 100.0)]
    df = spark.createDataFrame(flat + spiky, "w string, d int, v double")
    got = finops.anomaly_rows(df, ["w"], "d", "v", F.lit(True)).collect()
    assert [(r["w"], r["d"], r["anomaly_level"]) for r in got] == [("w2", 30, labels.ANOMALY["extreme"])]


def test_forecast_line(spark):
    df = spark.sql("SELECT 'a' k, add_months(DATE'2024-01-01', CAST(id AS INT)) month, 100.0 + 10 * id v FROM range(12)")
    got = forecast(df, ["k"], "month", "v", 3).filter("forecast IS NOT NULL").orderBy("month").collect()
    assert [(r["month"], r["forecast"], r["lower_bound"]) for r in got] == [(dt.date(2025, m, 1), 210.0 + 10 * m, 210.0 + 10 * m) for m in (1, 2, 3)]


def test_series_anomaly(spark):
    df = spark.createDataFrame([("a", i, 10.0 + i % 3) for i in range(20)] + [("a", 20, 60.0)], "k string, t int, v double")
    flagged = anomalies(df, ["k"], "t", "v").filter("is_anomaly").collect()
    assert 20 in [r["t"] for r in flagged] and all(r["percentile"] == 1.0 for r in flagged if r["t"] == 20)


# -- semantic layer --------------------------------------------------------------------------------


def test_metrics_do_not_fan_out(spark):
    c = spark.createDataFrame([(1, "s", 100), (2, "s", 50), (3, None, 7)], "c int, seg string, mrr int")
    s = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (4, 2), (5, 3)], "sid int, c int")
    m = SemanticModel(
        tables={"c": c, "s": s}, keys={"c": "c", "s": "sid"}, relationships=[("s", "c", "c")],
        dimensions={"seg": Named("c", F.col("seg"), "Segment", ("tier",)), "sid": Named("s", F.col("sid"))},
        metrics={"mrr": Named("c", F.sum("mrr"), "Revenue"), "subs": Named("s", F.count("sid"))},
    )
    assert rows(query_metrics(m, ["revenue", "subs"], ["tier"])) == [("s", 150, 4), (None, 7, 1)]
    assert rows(query_metrics(m, ["mrr", "subs"], [])) == [(157, 5)]
    with pytest.raises(ValueError):
        query_metrics(m, ["mrr"], ["sid"])
    with pytest.raises(KeyError):
        query_metrics(m, ["unknown"], [])


def test_semantic_view_comments(spark):
    v = semantic_view(spark.range(1), {"id": "the key"}, {"id": "k"})
    assert v.columns == ["k"] and v.schema["k"].metadata == {"comment": "the key"}


def test_generators_deal_few_seeds_over_tasks(spark, tmp_path):
    spark.range(2000).select(F.col("id").alias("c_custkey")).coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    usage = generators.QUERIES["gen_star_usage"](Lab(spark, str(tmp_path)))
    per_task = [r[0] for r in usage.groupBy(F.spark_partition_id()).agg(F.count("*")).select("count(1)").collect()]
    assert len(per_task) >= 8 and max(per_task) < sum(per_task) / 4
