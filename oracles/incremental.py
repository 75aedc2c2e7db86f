"""SQL statements of change capture, merges, snapshots and monitoring."""

from oracles.medallion import BRONZE, SILVER, gold_revenue

V = """v1 AS (SELECT customer_id, company_name, segment, account_status, csm_owner, created_date FROM customers),
 v2 AS (SELECT customer_id, company_name, segment, CASE WHEN customer_id % 13 = 0 THEN 'Churned' ELSE account_status END AS account_status, csm_owner, created_date
        FROM v1 WHERE customer_id % 17 <> 0
        UNION ALL SELECT customer_id + 1000000000, company_name || ' II', segment, account_status, csm_owner, created_date FROM v1 WHERE customer_id % 19 = 0)"""
DIM = f"""{V}, dim AS (SELECT customer_id + 1 AS customer_sk, customer_id, company_name, segment, account_status, csm_owner,
   date_diff('month', created_date, DATE '2001-08-02') AS tenure_months, TIMESTAMP '2024-01-01' AS effective_from FROM v1),
 fresh AS (SELECT customer_id, company_name, segment, account_status, csm_owner, date_diff('month', created_date, DATE '2001-08-02') AS tenure_months FROM v2)"""


def dimension(add_versions: bool, close_deleted: bool) -> str:
    closed = "f.customer_id IS NOT NULL AND f.account_status <> d.account_status"
    if close_deleted:
        closed = f"(f.customer_id IS NULL OR f.account_status <> d.account_status)"
    new = "d.customer_id IS NULL" + (" OR f.account_status <> d.account_status" if add_versions else "")
    return f"""WITH {DIM} SELECT d.customer_sk, d.customer_id, d.company_name, d.segment, d.account_status, d.csm_owner, d.tenure_months, NOT ({closed}) AS is_current,
      d.effective_from, CASE WHEN {closed} THEN TIMESTAMP '2024-01-31' END AS effective_to FROM dim d LEFT JOIN fresh f ON d.customer_id = f.customer_id
      UNION ALL SELECT (SELECT max(customer_sk) FROM dim) + row_number() OVER (ORDER BY f.customer_id), f.customer_id, f.company_name, f.segment, f.account_status,
      f.csm_owner, f.tenure_months, true, TIMESTAMP '2024-01-31', NULL FROM fresh f LEFT JOIN dim d ON d.customer_id = f.customer_id WHERE {new}"""


FEED = f"""{V}, feed AS (SELECT o.*, 'DELETE' AS _action, n.customer_id IS NOT NULL AS _is_update FROM v1 o LEFT JOIN v2 n ON o.customer_id = n.customer_id
    WHERE n.customer_id IS NULL OR n.account_status <> o.account_status
   UNION ALL SELECT n.*, 'INSERT', o.customer_id IS NOT NULL FROM v2 n LEFT JOIN v1 o ON o.customer_id = n.customer_id
    WHERE o.customer_id IS NULL OR n.account_status <> o.account_status)"""
SV = """s2 AS (SELECT subscription_id, customer_id, product_name,
   CASE WHEN subscription_id % 11 = 0 THEN mrr_amount + 50 WHEN subscription_id % 7 = 0 THEN mrr_amount - 25 ELSE mrr_amount END AS mrr_amount
   FROM subscriptions WHERE subscription_id % 23 <> 0
   UNION ALL SELECT subscription_id + 1000000000, customer_id, product_name, mrr_amount FROM subscriptions WHERE subscription_id % 29 = 0)"""
SFEED = f"""{SV}, sfeed AS (SELECT o.subscription_id, o.customer_id, o.product_name, o.mrr_amount, 'DELETE' AS _action, n.subscription_id IS NOT NULL AS _is_update
    FROM subscriptions o LEFT JOIN s2 n USING (subscription_id) WHERE n.subscription_id IS NULL OR n.mrr_amount <> o.mrr_amount
   UNION ALL SELECT n.subscription_id, n.customer_id, n.product_name, n.mrr_amount, 'INSERT', o.subscription_id IS NOT NULL
    FROM s2 n LEFT JOIN subscriptions o USING (subscription_id) WHERE o.subscription_id IS NULL OR n.mrr_amount <> o.mrr_amount)"""
MONTHS = """CAST(date_trunc('month', usage_date) AS DATE) AS usage_month, CAST(sum(emails_sent) AS BIGINT) AS total_emails, CAST(sum(social_posts) AS BIGINT) AS total_social_posts,
   CAST(sum(messages_sent) AS BIGINT) AS total_messages, CAST(sum(total_logins) AS BIGINT) AS total_logins, CAST(sum(session_minutes) AS DOUBLE) AS total_session_minutes"""
STAGING = f"""{BRONZE}, staging AS (SELECT customer_id, segment, health_score, _batch_id FROM bronze UNION ALL
   SELECT customer_id + 1000000000, segment, 50 + customer_id * 7 % 50, 'batch_2024_004' FROM customers WHERE customer_id % 100 = 0)"""

SQL = {
    "customer_changes": f"WITH {FEED} SELECT * FROM feed",
    "scd_merge": dimension(True, False),
    "scd_merge_as_written": dimension(False, False),
    "scd_merge_with_deletes": dimension(True, True),
    "usage_merge": f"""SELECT customer_id, {MONTHS},
      coalesce(nullif(count(DISTINCT user_id) FILTER (usage_date >= DATE '2024-01-16'), 0), count(DISTINCT user_id)) AS active_users FROM usage_daily GROUP BY 1, 2""",
    "usage_recomputed": f"SELECT customer_id, {MONTHS}, count(DISTINCT user_id) AS active_users FROM usage_daily GROUP BY 1, 2",
    "mrr_movements": f"""WITH {SV} SELECT DATE '2001-08-02' AS movement_date, coalesce(n.customer_id, o.customer_id) AS customer_id, subscription_id,
      coalesce(n.product_name, o.product_name) AS product_name,
      CASE WHEN o.mrr_amount IS NULL THEN 'NEW' WHEN n.mrr_amount IS NULL THEN 'CHURN' WHEN n.mrr_amount > o.mrr_amount THEN 'EXPANSION' ELSE 'CONTRACTION' END AS movement_type,
      CAST(coalesce(o.mrr_amount, 0) AS DOUBLE) AS previous_mrr, CAST(coalesce(n.mrr_amount, 0) AS DOUBLE) AS new_mrr,
      CAST(coalesce(n.mrr_amount, 0) - coalesce(o.mrr_amount, 0) AS DOUBLE) AS mrr_change
      FROM subscriptions o FULL OUTER JOIN s2 n USING (subscription_id) WHERE o.mrr_amount IS DISTINCT FROM n.mrr_amount""",
    "mrr_movements_as_written": f"""WITH {SFEED} SELECT DATE '2001-08-02' AS movement_date, customer_id, subscription_id, product_name,
      CASE WHEN _action = 'INSERT' AND NOT _is_update THEN 'NEW' WHEN _action = 'DELETE' AND NOT _is_update THEN 'CHURN'
           WHEN mrr_amount > 0 THEN 'EXPANSION' ELSE 'CONTRACTION' END AS movement_type,
      0 AS previous_mrr, CAST(mrr_amount AS DOUBLE) AS new_mrr, CAST(mrr_amount AS DOUBLE) AS mrr_change FROM sfeed""",
    "feed_status": f"""WITH {FEED}, {SFEED} SELECT 'CUSTOMERS_STREAM' AS stream_name, (SELECT count(*) FROM feed) AS pending_rows, TIMESTAMP '2024-01-31' AS last_processed
      UNION ALL SELECT 'SUBSCRIPTIONS_STREAM', (SELECT count(*) FROM sfeed), CAST((SELECT max(start_date) FROM subscriptions) AS TIMESTAMP)
      UNION ALL SELECT 'USAGE_STREAM', (SELECT count(*) FROM usage_daily WHERE usage_date >= DATE '2024-01-16'),
        CAST((SELECT max(usage_date) FROM usage_daily WHERE usage_date < DATE '2024-01-16') AS TIMESTAMP)""",
    "freshness": """SELECT name, schema_name, max(refresh_end_time) AS data_timestamp, date_diff('minute', max(refresh_end_time), TIMESTAMP '2024-01-31') AS current_lag_minutes,
      CASE WHEN date_diff('minute', max(refresh_end_time), TIMESTAMP '2024-01-31') <= 60 THEN 'WITHIN TARGET' ELSE 'LATE' END AS target_status
      FROM refresh_log WHERE state = 'SUCCEEDED' GROUP BY 1, 2""",
    "refresh_duration": """SELECT name, schema_name, state, count(*) AS refreshes,
      round(CAST(sum(date_diff('second', refresh_start_time, refresh_end_time)) AS DOUBLE) / count(*), 4) AS avg_seconds,
      max(date_diff('second', refresh_start_time, refresh_end_time)) AS max_seconds, CAST(sum(rows_inserted) AS BIGINT) AS rows_inserted
      FROM refresh_log WHERE name LIKE 'DT_%' GROUP BY 1, 2, 3""",
    "recent_refreshes": """SELECT refresh_id, name AS table_name, schema_name AS layer, refresh_start_time, date_diff('second', refresh_start_time, refresh_end_time) AS refresh_seconds
      FROM refresh_log ORDER BY refresh_start_time DESC, refresh_id LIMIT 20""",
    "stream_status": """SELECT 'STREAM_' || user_id AS name, CASE WHEN user_id % 10 <> 0 THEN max(ts) + INTERVAL 1 DAY END AS stale_after,
      CASE WHEN user_id % 10 = 0 THEN 'NEVER CONSUMED' WHEN max(ts) + INTERVAL 1 DAY < TIMESTAMP '2024-01-31' THEN 'STALE' ELSE 'CURRENT' END AS status
      FROM events GROUP BY user_id""",
    "as_of_read": f"WITH {V} SELECT * FROM v1",
    "now_vs_then": f"""WITH {V} SELECT 'NOW' AS time_point, count(*) AS customer_count, count(*) FILTER (account_status = 'Active') AS active_count FROM v2
      UNION ALL SELECT '10 MIN AGO', count(*), count(*) FILTER (account_status = 'Active') FROM v1""",
    "restore_deleted": f"WITH {V} SELECT * FROM v2 UNION ALL SELECT * FROM v1 WHERE customer_id NOT IN (SELECT customer_id FROM v2)",
    "restore_by_predicate": f"WITH {V} SELECT * FROM v2",
    "reload_table": f"WITH {V} SELECT * FROM v2",
    "layer_refresh": f"""WITH {SILVER}, loaded AS (SELECT customer_id, segment, health_score FROM sc
      UNION ALL SELECT customer_id + 1000000000, upper(segment), 50 + customer_id * 7 % 50 FROM customers WHERE customer_id % 100 = 0) {gold_revenue('loaded')}""",
    "delete_first_rows": f"WITH {V} SELECT * FROM v1 WHERE customer_id NOT IN (SELECT customer_id FROM v1 ORDER BY customer_id LIMIT 5)",
    "working_copy": """SELECT 'ORIGINAL' AS source, count(*) AS total, 0 AS test_status_count FROM customers
      UNION ALL SELECT 'CLONE', count(*), count(*) FILTER (company_name LIKE 'Customer#0000001%') FROM customers""",
    "past_copy": "SELECT account_status, count(*) AS customers FROM customers GROUP BY 1",
    "validate_staging": f"""WITH {STAGING} SELECT segment, staging_rows, staging_health, production_rows, production_health,
      CASE WHEN staging_rows >= production_rows AND staging_health BETWEEN 0 AND 100 THEN 'PASS' ELSE 'FAIL' END AS verdict FROM
      (SELECT segment, count(*) AS staging_rows, round(CAST(sum(health_score) AS DOUBLE) / count(health_score), 4) AS staging_health FROM staging GROUP BY 1) FULL OUTER JOIN
      (SELECT segment, count(*) AS production_rows, round(CAST(sum(health_score) AS DOUBLE) / count(health_score), 4) AS production_health FROM bronze GROUP BY 1) USING (segment)""",
    "batch_mix": f"""WITH {STAGING} SELECT _batch_id, count(*) AS records, 'production' AS version FROM staging GROUP BY 1
      UNION ALL SELECT _batch_id, count(*), 'rollback' FROM bronze GROUP BY 1""",
    "enrich_absent": "SELECT feedback_id, customer_id, nps_score FROM feedback WHERE feedback_id NOT IN (SELECT feedback_id FROM feedback WHERE feedback_id % 3 = 0)",
}
