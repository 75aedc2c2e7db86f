"""The lab tables as SQL over the registered parquet views (see tallyloom/sources/lab.py)."""

import re

TABLES = {
    "customers": """SELECT c_custkey AS customer_id, c_name AS company_name, c_mktsegment AS segment,
        CAST(c_acctbal AS DECIMAL(18,2)) AS mrr, CAST(c_custkey % 101 AS INTEGER) AS health_score,
        CASE WHEN c_custkey % 20 < 16 THEN 'Active' WHEN c_custkey % 20 < 18 THEN 'Churned'
             WHEN c_custkey % 20 < 19 THEN 'Paused' ELSE 'Trial' END AS account_status,
        'CSM' || (c_custkey % 10) AS csm_owner, DATE '1993-01-01' + CAST(c_custkey % 730 AS INTEGER) AS created_date,
        r_name AS industry, n_name AS state
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "subscriptions": """SELECT o_orderkey AS subscription_id, o_custkey AS customer_id, o_orderpriority AS product_name,
        CASE o_orderkey % 3 WHEN 0 THEN 'Starter' WHEN 1 THEN 'Professional' ELSE 'Enterprise' END AS plan_tier,
        CAST(o_totalprice AS DECIMAL(18,2)) AS mrr_amount,
        CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 12 AS DECIMAL(18,2)) AS arr_amount,
        CAST(o_orderkey % 4 * 5 AS INTEGER) AS discount_percent,
        CASE o_orderstatus WHEN 'O' THEN 'Active' WHEN 'F' THEN 'Cancelled' ELSE 'Paused' END AS status,
        CAST(o_orderdate AS DATE) AS start_date,
        CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 365 AS INTEGER) END AS end_date
        FROM orders""",
    "users": """SELECT c_custkey * 10 + n AS user_id, c_custkey AS customer_id,
        CASE WHEN (c_custkey * 10 + n) % 97 = 0 THEN NULL
             ELSE lower(replace(c_name, '#', '.')) || n ||
                  CASE WHEN (c_custkey * 10 + n) % 89 = 0 THEN ' at ' ELSE '@' END || 'mail' || c_nationkey || '.example.com'
        END AS email,
        '(' || lpad(CAST(200 + c_custkey % 800 AS VARCHAR), 3, '0') || ') ' ||
        lpad(CAST((c_custkey * 7 + n) % 1000 AS VARCHAR), 3, '0') || '-' ||
        lpad(CAST((c_custkey * 31 + n * 17) % 10000 AS VARCHAR), 4, '0') AS phone,
        'User' || n AS first_name, 'Of' || (c_custkey % 1000) AS last_name,
        'User' || n || ' Of' || (c_custkey % 1000) AS full_name,
        CASE (c_custkey + n) % 3 WHEN 0 THEN 'Admin' WHEN 1 THEN 'Advisor' ELSE 'Analyst' END AS role,
        CASE WHEN c_custkey % 20 < 16 AND (c_custkey + n) % 12 <> 0 THEN 'Active' ELSE 'Inactive' END AS user_status,
        DATE '2001-08-01' - CAST((c_custkey * 7 + n * 13) % 500 AS INTEGER) AS last_login_date,
        (c_custkey + n) % 10 < 7 AS mfa_enabled
        FROM customer, (VALUES (1), (2), (3)) AS m(n) WHERE n <= 2 + c_custkey % 2""",
    "usage_daily": """SELECT CAST(ts AS DATE) AS usage_date, user_id AS customer_id,
        user_id * 10 + day(CAST(ts AS DATE)) % 2 + 1 AS user_id,
        count(*) FILTER (event_type = 'view') AS emails_sent, count(*) FILTER (event_type = 'click') AS emails_opened,
        count(*) FILTER (event_type = 'purchase') AS emails_clicked, count(*) FILTER (event_type = 'signup') AS social_posts,
        count(*) FILTER (event_type = 'error') AS messages_sent, count(*) AS total_logins,
        sum(CAST(value AS DECIMAL(18,2))) AS session_minutes
        FROM events GROUP BY ALL""",
    "health_scores": """SELECT snapshot_date, customer_id, overall_health_score,
        CAST(least(100, n * 5) AS INTEGER) AS usage_score, CAST(least(100, n * 4 + 10) AS INTEGER) AS engagement_score,
        CAST((n * 13) % 101 AS INTEGER) AS support_score, CAST((n * 7) % 101 AS INTEGER) AS payment_score,
        CASE WHEN overall_health_score >= 80 THEN 'Low' WHEN overall_health_score >= 60 THEN 'Medium'
             WHEN overall_health_score >= 40 THEN 'High' ELSE 'Critical' END AS churn_risk,
        CASE n % 3 WHEN 0 THEN 'Improving' WHEN 1 THEN 'Stable' ELSE 'Declining' END AS health_trend
        FROM (SELECT user_id AS customer_id, CAST(date_trunc('week', ts) AS DATE) AS snapshot_date, count(*) AS n,
              CAST(least(100, floor(CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*))) AS INTEGER) AS overall_health_score
              FROM events GROUP BY ALL)""",
    "tickets": """SELECT event_id AS ticket_id, user_id AS customer_id, ts AS created_date,
        CASE event_id % 3 WHEN 0 THEN 'Technical' WHEN 1 THEN 'Billing' ELSE 'Training' END AS category,
        CASE event_id % 4 WHEN 0 THEN 'Low' WHEN 1 THEN 'Medium' WHEN 2 THEN 'High' ELSE 'Urgent' END AS priority,
        CASE event_id % 5 WHEN 0 THEN 'Open' WHEN 1 THEN 'In Progress' WHEN 2 THEN 'Resolved' WHEN 3 THEN 'Closed'
             ELSE 'Waiting on Customer' END AS status,
        CAST(1 + event_id % 5 AS INTEGER) AS csat_score, CAST(1 + event_id % 72 AS INTEGER) AS resolution_time_hours,
        event_id % 12 <> 0 AS sla_met FROM events WHERE event_type = 'error'""",
    "feedback": """SELECT doc_id AS feedback_id, doc_id % (SELECT count(*) FROM customer) AS customer_id,
        CAST(doc_id % 11 AS INTEGER) AS nps_score,
        CASE WHEN doc_id % 11 >= 9 THEN 'Promoter' WHEN doc_id % 11 >= 7 THEN 'Passive' ELSE 'Detractor' END AS nps_category,
        DATE '2024-01-01' + CAST(doc_id % 30 AS INTEGER) AS submitted_date, text AS feedback_text, lang, source
        FROM documents""",
    "knowledge_base": """SELECT doc_id AS article_id, source || ' ' || doc_id AS title, source AS category, lang AS product,
        text AS content FROM documents""",
    "chats": """SELECT conv_id AS conversation_id, conv_id % 50 AS user_id, 'agent_' || (conv_id % 3) AS agent_name,
        role AS message_role, text AS message_content, turn,
        TIMESTAMP '2024-01-01' + to_seconds(conv_id * 3600 + turn * 45 + turn * turn) AS message_timestamp
        FROM conversations""",
    "query_history": """SELECT event_id AS query_id,
        CASE event_id % 3 WHEN 0 THEN 'SELECT' WHEN 1 THEN 'INSERT' ELSE 'UPDATE' END AS query_type,
        'user_' || user_id AS user_name, 'role_' || (user_id % 5) AS role_name, 'WH_' || upper(event_type) AS warehouse_name,
        CASE user_id % 3 WHEN 0 THEN 'SMALL' WHEN 1 THEN 'MEDIUM' ELSE 'LARGE' END AS warehouse_size,
        CAST(CAST(value AS DECIMAL(18,2)) * 1000 AS BIGINT) AS total_elapsed_time, CAST(value AS DECIMAL(18,2)) AS credits_used,
        CAST(props->>'k' AS BIGINT) AS rows_produced, CAST(props->>'k' AS BIGINT) * 1073741824 AS bytes_scanned,
        'SELECT * FROM t WHERE p = ' || props AS query_text,
        CASE WHEN event_type = 'error' THEN 'FAIL' ELSE 'SUCCESS' END AS execution_status, ts AS start_time FROM events""",
    "metering": """SELECT 'WH_' || upper(event_type) AS warehouse_name, ts AS start_time,
        ts + to_seconds(event_id % 3600) AS end_time, CAST(value AS DECIMAL(18,2)) AS credits_used FROM events""",
    "long_metering": """SELECT (['WH_VIEW', 'WH_CLICK', 'WH_PURCHASE', 'WH_SIGNUP', 'WH_ERROR', 'WH_SPARE'])[l_suppkey % 6 + 1] AS warehouse_name, l_shipdate AS start_time,
        CAST(l_quantity AS DECIMAL(18,2)) AS credits_used FROM lineitem""",
    "logins": """SELECT event_id, ts AS event_timestamp, 'user_' || user_id AS user_name,
        '10.0.' || (user_id % 20) || '.' || (user_id % 7) AS client_ip,
        CASE event_id % 2 WHEN 0 THEN 'DRIVER' ELSE 'WEB' END AS reported_client_type,
        'PASSWORD' AS first_authentication_factor,
        CASE WHEN (event_id + user_id) % 3 = 0 THEN NULL ELSE 'TOTP' END AS second_authentication_factor,
        CASE WHEN event_type = 'error' THEN 'NO' ELSE 'YES' END AS is_success,
        CASE WHEN event_type = 'error' THEN 390100 + event_id % 3 END AS error_code,
        CASE WHEN event_type = 'error' THEN 'denied ' || (event_id % 3) END AS error_message FROM events""",
    "directory": """SELECT c_name AS user_name, lower(replace(c_name, '#', '.')) || '@example.com' AS email,
        CASE c_custkey % 7 WHEN 0 THEN 'ACCOUNTADMIN' WHEN 1 THEN 'SECURITYADMIN' WHEN 2 THEN 'SYSADMIN' ELSE 'ANALYST' END
        AS default_role, 'grantor_' || (c_custkey % 4) AS granted_by,
        DATE '2023-01-01' + CAST(c_custkey % 365 AS INTEGER) AS created_on,
        DATE '2024-01-31' - CAST(c_custkey * 11 % 200 AS INTEGER) AS last_success_login,
        CASE WHEN c_custkey % 9 = 0 THEN DATE '2024-01-15' END AS deleted_on FROM customer""",
    "direct_access": """SELECT l_shipdate AS query_start_time, 'user_' || l_suppkey AS user_name,
        unnest(['PROD.RAW.PART_' || (l_partkey % 25), 'PROD.RAW.USERS_' || (l_suppkey % 4)]) AS object_name FROM lineitem""",
    "modified": """SELECT l_orderkey AS query_id, l_shipdate AS query_start_time, 'user_' || l_suppkey AS user_name,
        'PROD.MART.SALES_' || (l_suppkey % 5) AS object_name, 'amount' AS columns_modified
        FROM lineitem WHERE l_returnflag IN ('R', 'A')
        UNION ALL SELECT l_orderkey, l_shipdate, 'user_' || l_suppkey, 'PROD.RAW.PART_' || (l_partkey % 10), 'stock'
        FROM lineitem WHERE l_returnflag = 'R'""",
    "flows": """SELECT l_shipdate AS query_start_time, unnest(src) AS source_table, tgt AS target_table FROM (
          SELECT l_shipdate, src, unnest(tgts) AS tgt FROM (
            SELECT l_shipdate, ['PROD.RAW.PART_' || (l_partkey % 25), 'PROD.RAW.USERS_' || (l_suppkey % 4)] AS src,
              CASE WHEN l_returnflag = 'R' THEN ['PROD.MART.SALES_' || (l_suppkey % 5), 'PROD.RAW.PART_' || (l_partkey % 10)]
                   WHEN l_returnflag = 'A' THEN ['PROD.MART.SALES_' || (l_suppkey % 5)] ELSE [] END AS tgts FROM lineitem))""",
    "dependencies": """SELECT DISTINCT 'PROD' AS referencing_database, 'MART' AS referencing_schema,
        'V_' || replace(p_brand, '#', '_') AS referencing_object_name, 'VIEW' AS referencing_object_domain,
        'PROD' AS referenced_database, 'RAW' AS referenced_schema, 'PART_' || (p_partkey % 25) AS referenced_object_name,
        'TABLE' AS referenced_object_domain FROM part""",
    "storage_daily": """SELECT CAST(ts AS DATE) AS usage_date, sum(CAST(props->>'k' AS BIGINT)) * 1073741824 AS storage_bytes,
        count(*) * 1073741824 AS stage_bytes, max(CAST(props->>'k' AS BIGINT)) * 1073741824 AS failsafe_bytes
        FROM events GROUP BY 1""",
    "table_storage": """SELECT source AS table_catalog, 'RAW' AS table_schema, lang AS table_name,
        sum(n_chars * 1000000) AS active_bytes, max(n_chars * 500000) AS time_travel_bytes,
        min(n_chars * 100000) AS failsafe_bytes, count(*) AS row_count FROM documents GROUP BY source, lang""",
    "refresh_log": """SELECT event_id AS refresh_id, 'DT_' || upper(event_type) AS name,
        CASE event_id % 2 WHEN 0 THEN 'SILVER' ELSE 'GOLD' END AS schema_name,
        CASE WHEN event_id % 25 = 0 THEN 'FAILED' ELSE 'SUCCEEDED' END AS state, ts AS refresh_start_time,
        ts + to_seconds(CAST(props->>'k' AS BIGINT)) AS refresh_end_time, CAST(props->>'k' AS BIGINT) AS rows_inserted
        FROM events""",
    "share_usage": """SELECT 'SHARE_' || left(o_orderpriority, 1) AS share_name, 'ACCOUNT_' || (o_custkey % 10) AS consumer_account,
        CAST(date_trunc('month', o_orderdate) AS DATE) AS query_date, count(*) AS query_count,
        CAST(sum(o_orderkey * 1024) AS BIGINT) AS storage_bytes FROM orders GROUP BY ALL""",
}


def bound(body: str) -> str:
    """``body`` with a WITH clause for each lab table that it names."""
    used = [n for n in TABLES if re.search(rf"\b{n}\b", body)]
    ctes = ",\n".join(f"{n} AS ({TABLES[n]})" for n in used)
    if not ctes:
        return body
    stripped = body.strip()
    if stripped[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{stripped[5:]}"
    return f"WITH {ctes}\n{stripped}"
