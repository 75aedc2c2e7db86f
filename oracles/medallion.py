"""SQL statements of the bronze, silver and gold layers."""

from tallyloom import labels

BRONZE = """bronze AS (SELECT customer_id, company_name, segment, industry, mrr, health_score, CAST(created_date AS VARCHAR) AS created_date,
    'crm' AS _source_system, TIMESTAMP '2024-01-01' AS _ingested_at, 'batch_2024_001' AS _batch_id FROM customers
  UNION ALL SELECT customer_id, company_name, segment, industry, mrr + 100,
    CASE WHEN customer_id % 50 = 0 THEN 101 WHEN customer_id % 70 = 0 THEN NULL ELSE health_score END,
    CASE WHEN customer_id % 40 = 0 THEN '2022-13-01' ELSE CAST(created_date AS VARCHAR) END, 'crm', TIMESTAMP '2024-01-02', 'batch_2024_002'
  FROM customers WHERE customer_id % 10 = 0)"""
SILVER = f"""{BRONZE}, sc AS (SELECT customer_id, company_name, upper(segment) AS segment, industry, mrr, health_score,
    try_cast(created_date AS DATE) AS created_date, _source_system, _ingested_at,
    CASE WHEN health_score BETWEEN 0 AND 100 THEN '{labels.QUALITY["valid"]}' ELSE '{labels.QUALITY["bad_score"]}' END AS _dq_status
    FROM bronze QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY _ingested_at DESC, _batch_id DESC) = 1),
  ss AS (SELECT subscription_id, customer_id, product_name, mrr_amount AS mrr, upper(status) AS status, start_date, 'billing' AS _source_system,
    TIMESTAMP '2024-01-01' AS _ingested_at FROM subscriptions),
  su AS (SELECT user_id, customer_id, email, phone, full_name, role AS user_role, 'identity' AS _source_system, TIMESTAMP '2024-01-01' AS _ingested_at FROM users)"""


def gold_360(users: str) -> str:
    return f"""WITH {SILVER} SELECT c.customer_id, c.company_name, c.segment, c.industry, c.health_score, c.created_date,
      date_diff('month', c.created_date, DATE '2001-08-02') AS tenure_months, count(DISTINCT s.subscription_id) AS product_count,
      CAST(sum(s.mrr) AS DOUBLE) AS total_mrr, CAST(sum(s.mrr) * 12 AS DOUBLE) AS total_arr,
      string_agg(DISTINCT s.product_name, ', ' ORDER BY s.product_name) AS products_owned,
      {users}
      CASE WHEN c.health_score >= 80 THEN '{labels.GOLD["healthy"]}' WHEN c.health_score >= 60 THEN '{labels.GOLD["risk"]}' ELSE '{labels.GOLD["critical"]}' END AS health_status
      FROM sc c LEFT JOIN ss s ON c.customer_id = s.customer_id AND s.status = 'ACTIVE' """


GROUP = " GROUP BY c.customer_id, c.company_name, c.segment, c.industry, c.health_score, c.created_date"

def gold_revenue(customers: str) -> str:
    return f"""SELECT c.segment, count(DISTINCT c.customer_id) AS customer_count, CAST(sum(s.mrr) AS DOUBLE) AS total_mrr,
      CAST(sum(s.mrr) * 12 AS DOUBLE) AS total_arr, round(CAST(sum(s.mrr) AS DOUBLE) / count(s.mrr), 4) AS avg_mrr_per_subscription,
      count(DISTINCT s.subscription_id) AS subscription_count, round(CAST(sum(c.health_score) AS DOUBLE) / count(c.health_score), 4) AS avg_health_score
      FROM {customers} c LEFT JOIN ss s ON c.customer_id = s.customer_id AND s.status = 'ACTIVE' GROUP BY 1"""


SQL = {
    "silver_customers": f"WITH {SILVER} SELECT * REPLACE (CAST(mrr AS DOUBLE) AS mrr) FROM sc",
    "silver_subscriptions": f"WITH {SILVER} SELECT * REPLACE (CAST(mrr AS DOUBLE) AS mrr) FROM ss",
    "silver_users": f"WITH {SILVER} SELECT * FROM su",
    "gold_customer_360": gold_360("(SELECT count(*) FROM su WHERE su.customer_id = c.customer_id) AS user_count,") + GROUP,
    "gold_customer_360_faithful": gold_360("count(DISTINCT u.user_id) AS user_count,") + " LEFT JOIN su u ON c.customer_id = u.customer_id " + GROUP,
    "gold_revenue": f"WITH {SILVER} {gold_revenue('sc')}",
    "gold_products": f"""WITH {SILVER} SELECT product_name, count(DISTINCT customer_id) AS customer_count, count(subscription_id) AS subscription_count,
      CAST(sum(CASE WHEN status = 'ACTIVE' THEN mrr ELSE 0 END) AS DOUBLE) AS active_mrr, CAST(sum(CASE WHEN status = 'CANCELLED' THEN mrr ELSE 0 END) AS DOUBLE) AS churned_mrr,
      round(sum(CASE WHEN status = 'CANCELLED' THEN 1 ELSE 0 END) * 100.0::DOUBLE / count(*), 2) AS churn_rate_pct FROM ss GROUP BY 1""",
    "bronze_batches": f"""WITH {BRONZE} SELECT _batch_id, _source_system, count(*) AS records,
      round(CAST(sum(health_score) AS DOUBLE) / count(health_score), 4) AS avg_health FROM bronze GROUP BY 1, 2""",
    "layer_counts": f"""WITH {SILVER} SELECT 'BRONZE' AS table_name, count(*) AS row_count FROM bronze
      UNION ALL SELECT 'SILVER', count(*) FROM sc UNION ALL SELECT 'GOLD', count(*) FROM sc""",
    "event_properties": """SELECT event_type, count(*) AS n, CAST(sum(CAST(props->>'k' AS INTEGER)) AS BIGINT) AS sum_k,
      count(*) FILTER (props->>'absent' IS NULL) AS absent, max(CAST(props->>'k' AS INTEGER)) AS max_k FROM events GROUP BY 1""",
}
