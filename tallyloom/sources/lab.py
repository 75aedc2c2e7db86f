"""The subscription-business tables, bound to the parquet test tables.

Each method is one lab table as a DataFrame. Derived attributes are plain key
arithmetic, so the same rows can be stated in ANSI SQL. A deployment replaces
this class by one that reads its own tables with the same columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.numbers import safe_div
from tallyloom.sources.tables import scan

ORDERS_AS_OF = "2001-08-02"
EVENTS_AS_OF = "2024-01-31"
ACCESS_AS_OF = "2001-08-02"


def daily_usage_of(events: DataFrame) -> DataFrame:
    """Per customer and day: counts per activity, logins and session minutes."""
    hits = lambda kind: F.count(F.when(F.col("event_type") == kind, 1))
    daily = events.groupBy(F.col("user_id"), F.to_date("ts").alias("usage_date")).agg(
        hits("view").alias("emails_sent"),
        hits("click").alias("emails_opened"),
        hits("purchase").alias("emails_clicked"),
        hits("signup").alias("social_posts"),
        hits("error").alias("messages_sent"),
        F.count("*").alias("total_logins"),
        F.sum(F.col("value").cast("decimal(18,2)")).alias("session_minutes"),
    )
    return daily.select(
        "usage_date", F.col("user_id").alias("customer_id"),
        (F.col("user_id") * 10 + F.dayofmonth("usage_date") % 2 + 1).alias("user_id"),
        "emails_sent", "emails_opened", "emails_clicked", "social_posts", "messages_sent", "total_logins",
        "session_minutes",
    )


class Lab:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def raw(self, name: str) -> DataFrame:
        return scan(self.spark, self.folder, name)

    # -- customers, subscriptions, users ---------------------------------

    def customers(self, geo: bool = False) -> DataFrame:
        """Customer accounts; ``geo`` adds industry (region) and state (nation)."""
        columns = [
            "c_custkey AS customer_id",
            "c_name AS company_name",
            "c_mktsegment AS segment",
            "CAST(c_acctbal AS DECIMAL(18,2)) AS mrr",
            "CAST(c_custkey % 101 AS INT) AS health_score",
            """CASE WHEN c_custkey % 20 < 16 THEN 'Active' WHEN c_custkey % 20 < 18 THEN 'Churned'
                    WHEN c_custkey % 20 < 19 THEN 'Paused' ELSE 'Trial' END AS account_status""",
            "concat('CSM', c_custkey % 10) AS csm_owner",
            "date_add(DATE'1993-01-01', CAST(c_custkey % 730 AS INT)) AS created_date",
        ]
        base = self.raw("customer")
        if geo:
            base = base.join(self.raw("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(
                self.raw("region"), F.col("n_regionkey") == F.col("r_regionkey")
            )
            columns += ["r_name AS industry", "n_name AS state"]
        return base.selectExpr(*columns)

    def subscriptions(self, since: Column | None = None) -> DataFrame:
        """Subscriptions; ``since`` drops earlier starts on the raw column, so the scan can skip row groups."""
        base = self.raw("orders")
        if since is not None:
            base = base.filter(F.col("o_orderdate") >= since.cast("timestamp_ntz"))
        return base.selectExpr(
            "o_orderkey AS subscription_id",
            "o_custkey AS customer_id",
            "o_orderpriority AS product_name",
            "CASE o_orderkey % 3 WHEN 0 THEN 'Starter' WHEN 1 THEN 'Professional' ELSE 'Enterprise' END AS plan_tier",
            "CAST(o_totalprice AS DECIMAL(18,2)) AS mrr_amount",
            "CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 12 AS DECIMAL(18,2)) AS arr_amount",
            "CAST(o_orderkey % 4 * 5 AS INT) AS discount_percent",
            "CASE o_orderstatus WHEN 'O' THEN 'Active' WHEN 'F' THEN 'Cancelled' ELSE 'Paused' END AS status",
            "CAST(o_orderdate AS DATE) AS start_date",
            """CASE WHEN o_orderstatus = 'F' THEN date_add(CAST(o_orderdate AS DATE), CAST(o_orderkey % 365 AS INT)) END
               AS end_date""",
        )

    def users(self) -> DataFrame:
        """Two or three users per customer, replicated by an explode with a per-row bound."""
        base = self.raw("customer").withColumn(
            "n", F.explode(F.sequence(F.lit(1), (2 + F.col("c_custkey") % 2).cast("int")))
        )
        return base.selectExpr(
            "c_custkey * 10 + n AS user_id",
            "c_custkey AS customer_id",
            """CASE WHEN (c_custkey * 10 + n) % 97 = 0 THEN NULL
                    ELSE concat(lower(replace(c_name, '#', '.')), n,
                         CASE WHEN (c_custkey * 10 + n) % 89 = 0 THEN ' at ' ELSE '@' END,
                         'mail', c_nationkey, '.example.com') END AS email""",
            """concat('(', lpad(CAST(200 + c_custkey % 800 AS STRING), 3, '0'), ') ',
                      lpad(CAST((c_custkey * 7 + n) % 1000 AS STRING), 3, '0'), '-',
                      lpad(CAST((c_custkey * 31 + n * 17) % 10000 AS STRING), 4, '0')) AS phone""",
            "concat('User', n) AS first_name",
            "concat('Of', c_custkey % 1000) AS last_name",
            "concat('User', n, ' Of', c_custkey % 1000) AS full_name",
            "CASE (c_custkey + n) % 3 WHEN 0 THEN 'Admin' WHEN 1 THEN 'Advisor' ELSE 'Analyst' END AS role",
            """CASE WHEN c_custkey % 20 < 16 AND (c_custkey + n) % 12 <> 0 THEN 'Active' ELSE 'Inactive' END
               AS user_status""",
            "date_sub(DATE'2001-08-01', CAST((c_custkey * 7 + n * 13) % 500 AS INT)) AS last_login_date",
            "(c_custkey + n) % 10 < 7 AS mfa_enabled",
        )

    # -- usage, health, tickets ------------------------------------------

    def usage_daily(self) -> DataFrame:
        return daily_usage_of(self.raw("events"))

    def health_scores(self) -> DataFrame:
        """Weekly snapshots with component scores, risk band and trend."""
        weekly = self.raw("events").groupBy(
            F.col("user_id").alias("customer_id"), F.trunc(F.to_date("ts"), "week").alias("snapshot_date")
        )
        scored = weekly.agg(
            F.count("*").alias("n"),
            F.floor(safe_div(F.sum(F.col("value").cast("decimal(18,2)")), F.count("*"))).alias("avg_value"),
        ).withColumn("overall_health_score", F.least(F.lit(100), F.col("avg_value")).cast("int"))
        return scored.selectExpr(
            "snapshot_date", "customer_id", "overall_health_score",
            "CAST(least(100, n * 5) AS INT) AS usage_score",
            "CAST(least(100, n * 4 + 10) AS INT) AS engagement_score",
            "CAST((n * 13) % 101 AS INT) AS support_score",
            "CAST((n * 7) % 101 AS INT) AS payment_score",
            """CASE WHEN overall_health_score >= 80 THEN 'Low' WHEN overall_health_score >= 60 THEN 'Medium'
                    WHEN overall_health_score >= 40 THEN 'High' ELSE 'Critical' END AS churn_risk""",
            "CASE n % 3 WHEN 0 THEN 'Improving' WHEN 1 THEN 'Stable' ELSE 'Declining' END AS health_trend",
        )

    def tickets(self) -> DataFrame:
        return self.raw("events").filter("event_type = 'error'").selectExpr(
            "event_id AS ticket_id",
            "user_id AS customer_id",
            "ts AS created_date",
            "CASE event_id % 3 WHEN 0 THEN 'Technical' WHEN 1 THEN 'Billing' ELSE 'Training' END AS category",
            "CASE event_id % 4 WHEN 0 THEN 'Low' WHEN 1 THEN 'Medium' WHEN 2 THEN 'High' ELSE 'Urgent' END AS priority",
            """CASE event_id % 5 WHEN 0 THEN 'Open' WHEN 1 THEN 'In Progress' WHEN 2 THEN 'Resolved'
                    WHEN 3 THEN 'Closed' ELSE 'Waiting on Customer' END AS status""",
            "CAST(1 + event_id % 5 AS INT) AS csat_score",
            "CAST(1 + event_id % 72 AS INT) AS resolution_time_hours",
            "event_id % 12 <> 0 AS sla_met",
        )

    # -- text -------------------------------------------------------------

    def feedback(self) -> DataFrame:
        """Survey answers: document text, its author account, score and date."""
        accounts = self.raw("customer").agg(F.count("*")).scalar()
        return self.raw("documents").withColumn("accounts", accounts).selectExpr(
            "doc_id AS feedback_id",
            "doc_id % accounts AS customer_id",
            "CAST(doc_id % 11 AS INT) AS nps_score",
            "CASE WHEN doc_id % 11 >= 9 THEN 'Promoter' WHEN doc_id % 11 >= 7 THEN 'Passive' ELSE 'Detractor' END AS nps_category",
            "date_add(DATE'2024-01-01', CAST(doc_id % 30 AS INT)) AS submitted_date",
            "text AS feedback_text",
            "lang", "source",
        )

    def knowledge_base(self) -> DataFrame:
        return self.raw("documents").selectExpr(
            "doc_id AS article_id", "source || ' ' || doc_id AS title", "source AS category", "lang AS product", "text AS content"
        )

    def conversations(self) -> DataFrame:
        return self.raw("conversations").select(
            F.col("conv_id").alias("conversation_id"),
            (F.col("conv_id") % 50).alias("user_id"),
            F.concat(F.lit("agent_"), F.col("conv_id") % 3).alias("agent_name"),
            F.col("role").alias("message_role"),
            F.col("text").alias("message_content"),
            F.col("turn"),
            F.expr("timestampadd(SECOND, conv_id * 3600 + turn * 45 + turn * turn, TIMESTAMP_NTZ'2024-01-01 00:00:00')").alias("message_timestamp"),
        )

    # -- logs --------------------------------------------------------------

    def query_history(self) -> DataFrame:
        return self.raw("events").withColumn("k", F.get_json_object("props", "$.k").cast("bigint")).selectExpr(
            "event_id AS query_id",
            "CASE event_id % 3 WHEN 0 THEN 'SELECT' WHEN 1 THEN 'INSERT' ELSE 'UPDATE' END AS query_type",
            "concat('user_', user_id) AS user_name",
            "concat('role_', user_id % 5) AS role_name",
            "concat('WH_', upper(event_type)) AS warehouse_name",
            "CASE user_id % 3 WHEN 0 THEN 'SMALL' WHEN 1 THEN 'MEDIUM' ELSE 'LARGE' END AS warehouse_size",
            "CAST(CAST(value AS DECIMAL(18,2)) * 1000 AS BIGINT) AS total_elapsed_time",
            "CAST(value AS DECIMAL(18,2)) AS credits_used",
            "k AS rows_produced",
            "k * 1073741824 AS bytes_scanned",
            "concat('SELECT * FROM t WHERE p = ', props) AS query_text",
            "CASE WHEN event_type = 'error' THEN 'FAIL' ELSE 'SUCCESS' END AS execution_status",
            "ts AS start_time",
        )

    def metering(self) -> DataFrame:
        return self.raw("events").selectExpr(
            "concat('WH_', upper(event_type)) AS warehouse_name",
            "ts AS start_time",
            "timestampadd(SECOND, event_id % 3600, ts) AS end_time",
            "CAST(value AS DECIMAL(18,2)) AS credits_used",
        )

    def long_metering(self) -> DataFrame:
        """Usage over years; the last warehouse has no configuration."""
        return self.raw("lineitem").selectExpr(
            "element_at(array('WH_VIEW', 'WH_CLICK', 'WH_PURCHASE', 'WH_SIGNUP', 'WH_ERROR', 'WH_SPARE'), CAST(l_suppkey % 6 + 1 AS INT)) AS warehouse_name",
            "l_shipdate AS start_time",
            "CAST(l_quantity AS DECIMAL(18,2)) AS credits_used",
        )

    def logins(self) -> DataFrame:
        return self.raw("events").selectExpr(
            "event_id",
            "ts AS event_timestamp",
            "concat('user_', user_id) AS user_name",
            "concat('10.0.', user_id % 20, '.', user_id % 7) AS client_ip",
            "CASE event_id % 2 WHEN 0 THEN 'DRIVER' ELSE 'WEB' END AS reported_client_type",
            "'PASSWORD' AS first_authentication_factor",
            "CASE WHEN (event_id + user_id) % 3 = 0 THEN NULL ELSE 'TOTP' END AS second_authentication_factor",
            "CASE WHEN event_type = 'error' THEN 'NO' ELSE 'YES' END AS is_success",
            "CASE WHEN event_type = 'error' THEN 390100 + event_id % 3 END AS error_code",
            "CASE WHEN event_type = 'error' THEN concat('denied ', event_id % 3) END AS error_message",
        )

    def directory(self) -> DataFrame:
        """User directory with role grants."""
        return self.raw("customer").selectExpr(
            "c_name AS user_name",
            "concat(lower(replace(c_name, '#', '.')), '@example.com') AS email",
            """CASE c_custkey % 7 WHEN 0 THEN 'ACCOUNTADMIN' WHEN 1 THEN 'SECURITYADMIN' WHEN 2 THEN 'SYSADMIN'
                    ELSE 'ANALYST' END AS default_role""",
            "concat('grantor_', c_custkey % 4) AS granted_by",
            "date_add(DATE'2023-01-01', CAST(c_custkey % 365 AS INT)) AS created_on",
            "date_sub(DATE'2024-01-31', CAST(c_custkey * 11 % 200 AS INT)) AS last_success_login",
            "CASE WHEN c_custkey % 9 = 0 THEN DATE'2024-01-15' END AS deleted_on",
        )

    def access_history(self) -> DataFrame:
        """One access per line item: objects read, base objects with columns, objects written."""
        return self.raw("lineitem").selectExpr(
            "l_orderkey AS query_id",
            "l_shipdate AS query_start_time",
            "concat('user_', l_suppkey) AS user_name",
            """array(named_struct('objectName', concat('PROD.RAW.PART_', l_partkey % 25)),
                     named_struct('objectName', concat('PROD.RAW.USERS_', l_suppkey % 4))) AS direct_objects_accessed""",
            """array(named_struct('objectName', concat('PROD.RAW.PART_', l_partkey % 25),
                                  'columns', array(named_struct('columnName', 'brand'),
                                                   named_struct('columnName', concat('c', l_linenumber)))),
                     named_struct('objectName', concat('PROD.RAW.USERS_', l_suppkey % 4),
                                  'columns', array(named_struct('columnName', 'email')))) AS base_objects_accessed""",
            """CASE WHEN l_returnflag = 'R' THEN
                      array(named_struct('objectName', concat('PROD.MART.SALES_', l_suppkey % 5), 'columns', 'amount'),
                            named_struct('objectName', concat('PROD.RAW.PART_', l_partkey % 10), 'columns', 'stock'))
                    WHEN l_returnflag = 'A' THEN
                      array(named_struct('objectName', concat('PROD.MART.SALES_', l_suppkey % 5), 'columns', 'amount'))
                    ELSE CAST(array() AS ARRAY<STRUCT<objectName STRING, columns STRING>>) END AS objects_modified""",
        )

    def dependencies(self) -> DataFrame:
        return self.raw("part").selectExpr(
            "'PROD' AS referencing_database", "'MART' AS referencing_schema",
            "concat('V_', replace(p_brand, '#', '_')) AS referencing_object_name", "'VIEW' AS referencing_object_domain",
            "'PROD' AS referenced_database", "'RAW' AS referenced_schema",
            "concat('PART_', p_partkey % 25) AS referenced_object_name", "'TABLE' AS referenced_object_domain",
        ).distinct()

    def storage_daily(self) -> DataFrame:
        return self.raw("events").withColumn("k", F.get_json_object("props", "$.k").cast("bigint")).groupBy(
            F.to_date("ts").alias("usage_date")
        ).agg(
            (F.sum("k") * 1073741824).alias("storage_bytes"),
            (F.count("*") * 1073741824).alias("stage_bytes"),
            (F.max("k") * 1073741824).alias("failsafe_bytes"),
        )

    def table_storage(self) -> DataFrame:
        return self.raw("documents").groupBy("source", "lang").agg(
            F.sum(F.col("n_chars") * 1000000).alias("active_bytes"),
            F.max(F.col("n_chars") * 500000).alias("time_travel_bytes"),
            F.min(F.col("n_chars") * 100000).alias("failsafe_bytes"),
            F.count("*").alias("row_count"),
        ).selectExpr(
            "source AS table_catalog", "'RAW' AS table_schema", "lang AS table_name",
            "active_bytes", "time_travel_bytes", "failsafe_bytes", "row_count",
        )

    def refresh_log(self) -> DataFrame:
        return self.raw("events").withColumn("k", F.get_json_object("props", "$.k").cast("bigint")).selectExpr(
            "event_id AS refresh_id",
            "concat('DT_', upper(event_type)) AS name",
            "CASE event_id % 2 WHEN 0 THEN 'SILVER' ELSE 'GOLD' END AS schema_name",
            "CASE WHEN event_id % 25 = 0 THEN 'FAILED' ELSE 'SUCCEEDED' END AS state",
            "ts AS refresh_start_time",
            "timestampadd(SECOND, k, ts) AS refresh_end_time",
            "k AS rows_inserted",
        )

    def share_usage(self) -> DataFrame:
        return self.raw("orders").groupBy(
            F.expr("concat('SHARE_', left(o_orderpriority, 1))").alias("share_name"),
            F.expr("concat('ACCOUNT_', o_custkey % 10)").alias("consumer_account"),
            F.trunc(F.to_date("o_orderdate"), "month").alias("query_date"),
        ).agg(F.count("*").alias("query_count"), F.sum(F.col("o_orderkey") * 1024).alias("storage_bytes"))
