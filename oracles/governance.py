"""SQL statements of governed reads, extracts and profiles."""

from oracles.products import SHARED

PATTERNS = {"EMAIL": "[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{2,}", "PHONE": "[(]?[0-9]{3}[)]?[ -][0-9]{3}-[0-9]{4}", "SSN": "[0-9]{3}-[0-9]{2}-[0-9]{4}",
            "NAME": "^[A-Z][a-z]+( [A-Z][.]?)? [A-Z][a-z]+$", "ADDRESS": "^[0-9]+ [A-Z][A-Za-z]+( [A-Z][A-Za-z]+)* (Street|St|Avenue|Ave|Road|Rd|Lane|Ln|Drive|Dr|Way|Square)[.]?(,|$)"}
HINT = {"full_name": "NAME", "first_name": "NAME", "last_name": "NAME", "email": "EMAIL", "phone": "PHONE", "role": "OTHER", "text": "OTHER", "lang": "OTHER", "source": "OTHER"}


def pii(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, '{HINT[c]}' AS name_category, '{k}' AS category, count({c}) AS non_null, count(*) FILTER (regexp_matches({c}, '{p}')) AS hits,
        round(count(*) FILTER (regexp_matches({c}, '{p}')) * 100.0::DOUBLE / count({c}), 4) AS hit_pct, '{table}' AS table_name FROM {table}"""
        for c in columns for k, p in PATTERNS.items()
    )


def profile(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS total_rows, count(*) - count({c}) AS null_count, count(DISTINCT {c}) AS unique_count,
        count({c}) - count(DISTINCT {c}) AS duplicate_count, '{table}' AS table_name FROM {table}""" for c in columns
    )


PEOPLE = ["full_name", "first_name", "last_name", "email", "phone", "role"]
COLS = "user_id, customer_id, full_name, first_name, last_name, email, phone, role"

SQL = {
    "masked_users_admin": f"SELECT {COLS} FROM users",
    "masked_users_analyst": f"""SELECT {COLS} FROM (SELECT * REPLACE (regexp_replace(email, '^[^@]+', '****') AS email,
      regexp_replace(left(phone, length(phone) - 4), '[0-9]', '*', 'g') || right(phone, 4) AS phone, left(first_name, 1) || '***' AS first_name, left(last_name, 1) || '***' AS last_name) FROM users)""",
    "masked_users_viewer": f"""SELECT {COLS} FROM (SELECT * REPLACE ('****@****.***' AS email, '(***) ***-****' AS phone, '***' AS first_name, '***' AS last_name) FROM users)""",
    "masked_users_short": f"""SELECT {COLS} FROM (SELECT * REPLACE (regexp_replace(email, '.+@', '****@') AS email, '(***) ***-' || right(phone, 4) AS phone,
      left(full_name, 1) || '. ' || split_part(full_name, ' ', -1) AS full_name) FROM users)""",
    "tag_masked": f"SELECT {COLS} FROM (SELECT * REPLACE ('***REDACTED***' AS email, '***REDACTED***' AS phone, left(full_name, 1) || '***' AS full_name) FROM users)",
    "revenue_masked": "SELECT subscription_id, CAST(mrr_amount AS DOUBLE) AS analyst, round(CAST(mrr_amount AS DOUBLE), -2) AS viewer, CAST(NULL AS DOUBLE) AS outsider FROM subscriptions",
    "governed_customers": """SELECT customer_id, left(company_name, 1) || '***' AS company_name, segment, CAST(mrr AS DOUBLE) AS mrr, health_score, account_status, csm_owner, created_date
      FROM customers WHERE account_status IN ('Active', 'Paused', 'Trial')""",
    "rows_by_status": """SELECT account_status, count(*) AS customers, 'admin' AS role FROM customers GROUP BY 1
      UNION ALL SELECT account_status, count(*), 'analyst' FROM customers WHERE account_status IN ('Active', 'Paused', 'Trial') GROUP BY 1""",
    "rows_by_owner": """SELECT csm_owner, count(*) AS customers, 'user_anna' AS "user", 'analyst' AS role FROM customers WHERE csm_owner = 'CSM3' GROUP BY 1
      UNION ALL SELECT csm_owner, count(*), 'user_control', 'viewer' FROM customers GROUP BY 1 UNION ALL SELECT csm_owner, count(*), 'user_unknown', 'engineer' FROM customers GROUP BY 1""",
    "customers_with_tickets": """SELECT customer_id, company_name, segment FROM customers c
      WHERE EXISTS (SELECT 1 FROM tickets t WHERE t.customer_id = c.customer_id AND t.priority = 'Urgent')""",
    "shared_customers": """SELECT customer_id, company_name, segment, industry, state, account_status, created_date, date_diff('month', created_date, DATE '2001-08-02') AS tenure_months,
      account_status = 'Active' AS is_active FROM customers WHERE account_status IN ('Active', 'Paused')""",
    "shared_subscriptions": """SELECT customer_id, product_name, plan_tier, status, start_date, CAST(mrr_amount AS DOUBLE) AS mrr_amount, CAST(arr_amount AS DOUBLE) AS arr_amount,
      CASE WHEN discount_percent > 0 THEN 'Discounted' ELSE 'Standard' END AS pricing_type FROM subscriptions WHERE status IN ('Active', 'Paused')""",
    "shared_usage": """SELECT customer_id, CAST(date_trunc('month', usage_date) AS DATE) AS usage_month, CAST(sum(emails_sent) AS BIGINT) AS total_emails_sent,
      CAST(sum(social_posts) AS BIGINT) AS total_social_posts, CAST(sum(messages_sent) AS BIGINT) AS total_texts, CAST(sum(total_logins) AS BIGINT) AS total_logins,
      round(CAST(sum(session_minutes) AS DOUBLE) / count(*), 4) AS avg_session_duration FROM usage_daily GROUP BY 1, 2""",
    "benchmark_k_anon": f"""WITH {SHARED} SELECT industry, segment, count(*) AS sample_size, round(CAST(sum(overall_health_score) AS DOUBLE) / count(overall_health_score), 4) AS avg_health_score,
      round(CAST(sum(tenure_months) AS DOUBLE) / count(*), 4) AS avg_tenure_months, round(CAST(sum(products) AS DOUBLE) / count(*), 4) AS avg_products,
      round(quantile_cont(CAST(mrr AS DOUBLE), 0.5), 4) AS median_mrr FROM shared GROUP BY 1, 2 HAVING count(*) >= 10""",
    "pii_profile": pii("documents", ["text", "lang", "source"]) + " UNION ALL " + pii("users", PEOPLE),
    "dq_customers": """SELECT 'CUSTOMERS' AS table_name, count(*) AS total_rows, count(DISTINCT customer_id) AS unique_customers, count(*) - count(company_name) AS null_company_names,
      count(*) - count(segment) AS null_segments, count(*) - count(account_status) AS null_statuses,
      count(*) FILTER (account_status NOT IN ('Active', 'Churned', 'Paused', 'Trial')) AS invalid_statuses,
      round(count(*) FILTER (account_status = 'Active') * 100.0::DOUBLE / count(*), 2) AS pct_active FROM customers""",
    "dq_users": """SELECT 'USERS' AS table_name, count(*) AS total_rows, count(DISTINCT user_id) AS unique_users, count(DISTINCT customer_id) AS unique_customers,
      count(*) - count(email) AS null_emails, count(*) FILTER (email NOT LIKE '%@%.%') AS invalid_emails, count(*) FILTER (last_login_date < DATE '2000-08-02') AS stale_users,
      round(count(*) FILTER (mfa_enabled) * 100.0::DOUBLE / count(*), 2) AS pct_mfa_enabled FROM users""",
    "dq_generic": profile("documents", ["doc_id", "text", "lang", "source", "n_chars"]) + " UNION ALL " + profile("users", ["user_id", "customer_id", *PEOPLE]),
    "repeated_line_keys": "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
}
SQL["published_extract"] = SQL["shared_customers"]
