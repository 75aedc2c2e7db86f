"""SQL statements of the data products."""

from tallyloom import labels

PER = """per AS (SELECT c.*, t.product_count, t.total_mrr, t.active_mrr, t.churned_mrr FROM customers c LEFT JOIN (
  SELECT customer_id, count(*) AS product_count, sum(mrr_amount) AS total_mrr,
    sum(CASE WHEN status = 'Active' THEN mrr_amount ELSE 0 END) AS active_mrr,
    sum(CASE WHEN status = 'Cancelled' THEN mrr_amount ELSE 0 END) AS churned_mrr
  FROM subscriptions GROUP BY 1) t USING (customer_id))"""

ACTIVE = """act AS (SELECT customer_id, sum(mrr_amount) AS total_mrr, sum(arr_amount) AS total_arr, count(*) AS product_count,
  string_agg(DISTINCT product_name, ', ' ORDER BY product_name) AS products_list
  FROM subscriptions WHERE status = 'Active' GROUP BY 1)"""
HEALTH = """lh AS (SELECT * FROM health_scores QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY snapshot_date DESC) = 1)"""
USERT = """ut AS (SELECT customer_id, count(*) AS total_users, count(*) FILTER (user_status = 'Active') AS active_users,
  max(last_login_date) AS last_login FROM users GROUP BY 1)"""
TICK = """tk AS (SELECT customer_id, count(*) AS ticket_count, round(CAST(sum(csat_score) AS DOUBLE) / count(*), 4) AS avg_csat
  FROM tickets WHERE created_date >= DATE '2024-01-31' - 90 GROUP BY 1)"""
NPS = """np AS (SELECT customer_id, nps_score AS latest_nps_score, nps_category FROM feedback
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY submitted_date DESC, feedback_id DESC) = 1)"""
C360 = f"""{ACTIVE}, {HEALTH}, {USERT}, {TICK}, {NPS}, c360 AS (SELECT c.customer_id, company_name, segment, industry, state, account_status, csm_owner,
  created_date AS customer_since, date_diff('month', created_date, DATE '2001-08-02') AS tenure_months,
  coalesce(total_mrr, 0) AS total_mrr, coalesce(total_arr, 0) AS total_arr, coalesce(product_count, 0) AS active_products, products_list,
  coalesce(total_users, 0) AS total_users, coalesce(active_users, 0) AS active_users, last_login,
  date_diff('day', last_login, DATE '2001-08-02') AS days_since_last_login, overall_health_score, churn_risk, health_trend,
  coalesce(ticket_count, 0) AS tickets_90d, avg_csat, latest_nps_score, nps_category,
  CASE WHEN account_status = 'Churned' THEN '{labels.PROFILE["churned"]}' WHEN churn_risk = 'Critical' THEN '{labels.PROFILE["risk"]}'
       WHEN overall_health_score >= 80 THEN '{labels.PROFILE["healthy"]}' WHEN overall_health_score >= 60 THEN '{labels.PROFILE["attention"]}' ELSE '{labels.PROFILE["risk"]}' END AS customer_health_status
  FROM customers c LEFT JOIN act USING (customer_id) LEFT JOIN ut USING (customer_id) LEFT JOIN lh USING (customer_id)
  LEFT JOIN tk USING (customer_id) LEFT JOIN np USING (customer_id))"""
SHARED = f"""{ACTIVE}, {HEALTH}, shared AS (SELECT c.customer_id, company_name, segment, industry, state, account_status,
  date_diff('month', created_date, DATE '2001-08-02') AS tenure_months, coalesce(total_mrr, 0) AS mrr, coalesce(product_count, 0) AS products,
  overall_health_score, churn_risk FROM customers c LEFT JOIN act USING (customer_id) LEFT JOIN lh USING (customer_id)
  WHERE account_status IN ('Active', 'Paused'))"""
REVMONTH = """rm AS (SELECT CAST(date_trunc('month', start_date) AS DATE) AS revenue_month, segment, industry, product_name, plan_tier,
  count(DISTINCT subscription_id) AS subscription_count, count(DISTINCT s.customer_id) AS customer_count,
  sum(mrr_amount) AS total_mrr, sum(arr_amount) AS total_arr, round(CAST(sum(mrr_amount) AS DOUBLE) / count(*), 4) AS avg_mrr,
  sum(CASE WHEN status = 'Active' THEN mrr_amount ELSE 0 END) AS active_mrr,
  sum(CASE WHEN status = 'Cancelled' THEN mrr_amount ELSE 0 END) AS churned_mrr,
  round(count(CASE WHEN status = 'Cancelled' THEN 1 END) * 100.0::DOUBLE / count(*), 2) AS churn_rate_pct
  FROM subscriptions s JOIN customers c ON s.customer_id = c.customer_id GROUP BY 1, 2, 3, 4, 5)"""
DASH = f"""{ACTIVE}, {HEALTH}, use7 AS (SELECT customer_id,
  sum(CASE WHEN usage_date >= DATE '2024-01-31' - 7 THEN total_logins ELSE 0 END) AS last_7d_logins,
  sum(CASE WHEN usage_date >= DATE '2024-01-31' - 30 THEN emails_sent ELSE 0 END) AS last_30d_emails FROM usage_daily GROUP BY 1),
 sup AS (SELECT customer_id, count(CASE WHEN status IN ('Open', 'In Progress') THEN 1 END) AS open_tickets,
  round(CAST(sum(csat_score) FILTER (created_date >= DATE '2024-01-31' - 30) AS DOUBLE) / nullif(count(*) FILTER (created_date >= DATE '2024-01-31' - 30), 0), 4) AS avg_recent_csat
  FROM tickets GROUP BY 1),
 dash AS (SELECT c.customer_id, company_name, segment, industry, csm_owner, account_status, overall_health_score, usage_score, engagement_score,
  support_score, payment_score, churn_risk, health_trend, snapshot_date AS health_score_date, CAST(coalesce(total_mrr, 0) AS DOUBLE) AS mrr_at_risk,
  CAST(coalesce(last_7d_logins, 0) AS BIGINT) AS logins_last_7d, CAST(coalesce(last_30d_emails, 0) AS BIGINT) AS emails_last_30d, coalesce(open_tickets, 0) AS open_tickets,
  coalesce(avg_recent_csat, 0) AS recent_csat,
  CASE WHEN churn_risk = 'Critical' AND total_mrr > 500 THEN '{labels.ACTION["executive"]}'
       WHEN churn_risk = 'Critical' THEN '{labels.ACTION["call"]}'
       WHEN churn_risk = 'High' AND health_trend = 'Declining' THEN '{labels.ACTION["check_in"]}'
       WHEN usage_score < 40 THEN '{labels.ACTION["training"]}'
       WHEN last_7d_logins = 0 THEN '{labels.ACTION["re_engage"]}'
       WHEN open_tickets > 3 THEN '{labels.ACTION["tickets"]}'
       ELSE '{labels.ACTION["none"]}' END AS recommended_action
  FROM customers c LEFT JOIN lh USING (customer_id) LEFT JOIN act USING (customer_id) LEFT JOIN use7 USING (customer_id) LEFT JOIN sup USING (customer_id)
  WHERE account_status = 'Active' AND churn_risk IN ('Critical', 'High', 'Medium'))"""
CBASE = f"""{HEALTH}, cbase AS (SELECT c.customer_id, company_name AS customer_name, segment AS customer_segment, industry, state, account_status,
  csm_owner AS customer_success_manager, created_date AS customer_since_date,
  date_diff('month', created_date, DATE '2001-08-02') AS customer_tenure_months, date_diff('year', created_date, DATE '2001-08-02') AS customer_tenure_years,
  overall_health_score, usage_score, engagement_score, support_score, payment_score, churn_risk, health_trend, snapshot_date AS health_score_date
  FROM customers c LEFT JOIN lh USING (customer_id))"""
RBASE = """rbase AS (SELECT subscription_id, s.customer_id, company_name AS customer_name, segment AS customer_segment, industry, product_name, plan_tier,
  status AS subscription_status, start_date AS subscription_start_date, end_date AS subscription_end_date,
  CAST(date_trunc('month', start_date) AS DATE) AS cohort_month, CAST(date_trunc('quarter', start_date) AS DATE) AS cohort_quarter,
  CAST(date_trunc('year', start_date) AS DATE) AS cohort_year, CAST(mrr_amount AS DOUBLE) AS monthly_recurring_revenue,
  CAST(arr_amount AS DOUBLE) AS annual_recurring_revenue, discount_percent,
  CAST(mrr_amount * (100 - discount_percent) AS DOUBLE) / 100 AS net_mrr, mrr_amount AS mrr
  FROM subscriptions s JOIN customers c ON s.customer_id = c.customer_id)"""
UBASE = """ubase AS (SELECT usage_date, CAST(date_trunc('week', usage_date) AS DATE) AS usage_week, CAST(date_trunc('month', usage_date) AS DATE) AS usage_month,
  CAST(date_trunc('quarter', usage_date) AS DATE) AS usage_quarter, left(dayname(usage_date), 3) AS day_of_week, u.customer_id,
  company_name AS customer_name, segment AS customer_segment, industry, user_id, emails_sent, emails_opened, emails_clicked,
  CASE WHEN emails_sent > 0 THEN round(emails_opened * 100.0::DOUBLE / emails_sent, 4) ELSE 0 END AS email_open_rate,
  CASE WHEN emails_opened > 0 THEN round(emails_clicked * 100.0::DOUBLE / emails_opened, 4) ELSE 0 END AS email_click_rate,
  social_posts, messages_sent, messages_sent + emails_opened AS total_messages, total_logins, session_minutes
  FROM usage_daily u JOIN customers c ON u.customer_id = c.customer_id)"""
SBASE = """sbase AS (SELECT ticket_id, t.customer_id, company_name AS customer_name, segment AS customer_segment, category AS ticket_category,
  priority AS ticket_priority, status AS ticket_status, created_date AS ticket_created_date,
  CAST(date_trunc('month', t.created_date) AS DATE) AS ticket_month, CAST(date_trunc('week', t.created_date) AS DATE) AS ticket_week, resolution_time_hours,
  csat_score AS customer_satisfaction_score, sla_met, CASE WHEN status IN ('Resolved', 'Closed') THEN 1 ELSE 0 END AS is_resolved,
  CASE WHEN priority IN ('High', 'Urgent') THEN 1 ELSE 0 END AS is_high_priority
  FROM (SELECT * FROM tickets) t JOIN (SELECT customer_id, company_name, segment FROM customers) c ON t.customer_id = c.customer_id)"""
MRRH = """mh AS (SELECT CAST(date_trunc('month', start_date) AS DATE) AS month, sum(mrr_amount) AS total_mrr, count(DISTINCT customer_id) AS customer_count
  FROM subscriptions WHERE status = 'Active' AND start_date >= DATE '2001-08-02' - INTERVAL 24 MONTH GROUP BY 1)"""
DU = """du AS (SELECT usage_date, count(DISTINCT customer_id) AS active_customers, CAST(sum(emails_sent) AS BIGINT) AS total_emails,
  CAST(sum(total_logins) AS BIGINT) AS total_logins, round(CAST(sum(session_minutes) AS DOUBLE) / count(*), 4) AS avg_session_minutes
  FROM usage_daily WHERE usage_date >= DATE '2024-01-31' - 90 GROUP BY 1)"""
CHANGE = """ch AS (SELECT coalesce(c.segment, p.segment) AS segment, coalesce(c.industry, p.industry) AS industry, coalesce(c.product_name, p.product_name) AS product_name,
  coalesce(p.mrr, 0) AS prior_mrr, coalesce(c.mrr, 0) AS current_mrr FROM
  (SELECT segment, industry, product_name, sum(mrr_amount) AS mrr FROM subscriptions JOIN customers USING (customer_id)
    WHERE status = 'Active' AND start_date <= DATE '2001-08-02' GROUP BY ALL) c FULL OUTER JOIN
  (SELECT segment, industry, product_name, sum(mrr_amount) AS mrr FROM subscriptions JOIN customers USING (customer_id)
    WHERE status = 'Active' AND start_date <= DATE '2001-07-02' GROUP BY ALL) p
  ON c.segment = p.segment AND c.industry = p.industry AND c.product_name = p.product_name),
 chd AS (SELECT segment, industry, product_name, CAST(prior_mrr AS DOUBLE) AS prior_mrr, CAST(current_mrr AS DOUBLE) AS current_mrr,
  CAST(current_mrr - prior_mrr AS DOUBLE) AS mrr_change,
  round(CAST(current_mrr - prior_mrr AS DOUBLE) * 100.0 / nullif(CAST(prior_mrr AS DOUBLE), 0), 2) AS pct_change FROM ch)"""
AGENT = f"""{HEALTH}, seen AS (SELECT customer_id, date_diff('day', max(usage_date), DATE '2024-01-31') AS d FROM usage_daily GROUP BY 1),
 rev AS (SELECT customer_id, sum(mrr_amount) AS mrr FROM subscriptions WHERE status = 'Active' GROUP BY 1),
 ot AS (SELECT customer_id, count(*) AS open_tickets FROM tickets WHERE status IN ('Open', 'In Progress') GROUP BY 1),
 ag AS (SELECT c.customer_id, company_name, segment, industry, CAST(coalesce(rev.mrr, 0) AS DOUBLE) AS mrr, overall_health_score AS health_score, churn_risk, health_trend,
  coalesce(open_tickets, 0) AS open_tickets, coalesce(d, 999) AS quiet FROM customers c LEFT JOIN rev ON c.customer_id = rev.customer_id
  LEFT JOIN lh ON c.customer_id = lh.customer_id LEFT JOIN ot ON c.customer_id = ot.customer_id LEFT JOIN seen ON c.customer_id = seen.customer_id
  WHERE account_status = 'Active')"""
COUNTED = ["customers", "users", "subscriptions", "usage_daily", "health_scores", "feedback", "tickets"]
NEWEST = "(SELECT * FROM health_scores WHERE snapshot_date = (SELECT max(snapshot_date) FROM health_scores))"

SQL = {
    "segment_ranking": f"""WITH {PER}, ranked AS (SELECT *,
        row_number() OVER (PARTITION BY segment ORDER BY total_mrr DESC NULLS FIRST, customer_id) AS segment_rank,
        percent_rank() OVER (PARTITION BY segment ORDER BY total_mrr NULLS LAST) AS mrr_percentile FROM per),
      bench AS (SELECT segment AS seg, CAST(sum(total_mrr) AS DOUBLE) / count(total_mrr) AS segment_avg_mrr FROM per GROUP BY 1)
      SELECT segment, industry, count(*) AS customer_count, CAST(sum(total_mrr) AS DOUBLE) AS total_mrr,
        round(CAST(sum(health_score) AS DOUBLE) / count(*), 2) AS avg_health, round(avg(mrr_percentile), 4) AS avg_percentile,
        CAST(sum(CASE WHEN segment_rank <= 10 THEN 1 ELSE 0 END) AS BIGINT) AS top_10_customers, round(max(segment_avg_mrr), 2) AS segment_benchmark_mrr
      FROM ranked JOIN bench ON segment = seg GROUP BY segment, industry HAVING count(*) > 5""",
    "ranked_customers": f"""WITH {PER}, seg AS (SELECT segment AS s, sum(total_mrr) AS st, round(CAST(sum(total_mrr) AS DOUBLE) / count(total_mrr), 2) AS sa FROM per GROUP BY 1)
      SELECT customer_id, segment, CAST(total_mrr AS DOUBLE) AS total_mrr,
        row_number() OVER (PARTITION BY segment ORDER BY total_mrr DESC NULLS FIRST, customer_id) AS segment_rank,
        round(percent_rank() OVER (PARTITION BY segment ORDER BY total_mrr NULLS LAST), 6) AS mrr_percentile,
        sa AS segment_avg_mrr, CAST(st AS DOUBLE) AS segment_total_mrr, count(*) OVER (PARTITION BY segment) AS segment_customer_count,
        CAST(lag(total_mrr) OVER (PARTITION BY segment ORDER BY total_mrr DESC NULLS FIRST, customer_id) AS DOUBLE) AS prev_customer_mrr,
        CAST(lead(total_mrr) OVER (PARTITION BY segment ORDER BY total_mrr DESC NULLS FIRST, customer_id) AS DOUBLE) AS next_customer_mrr
      FROM per JOIN seg ON segment = s""",
    "segment_matrix": f"""WITH {PER}, roll AS (SELECT segment, industry, sum(total_mrr) AS mrr FROM per GROUP BY 1, 2)
      SELECT a.segment AS segment_a, b.segment AS segment_b, a.industry AS industry_a, b.industry AS industry_b, CAST(a.mrr AS DOUBLE) AS mrr_a,
        CAST(b.mrr AS DOUBLE) AS mrr_b, CAST(a.mrr - b.mrr AS DOUBLE) AS mrr_diff FROM roll a CROSS JOIN roll b WHERE a.segment <> b.segment""",
    "segment_summary": f"""WITH {PER} SELECT segment, industry, count(DISTINCT customer_id) AS customers, CAST(sum(total_mrr) AS DOUBLE) AS mrr,
        round(CAST(sum(health_score) AS DOUBLE) / count(*), 4) AS avg_health, round(CAST(sum(coalesce(product_count, 0)) AS DOUBLE) / count(*), 4) AS avg_products,
        round(CAST(sum(churned_mrr) AS DOUBLE) * 100.0 / nullif(CAST(sum(total_mrr) AS DOUBLE), 0), 2) AS churn_rate FROM per GROUP BY 1, 2""",
    "revenue_by_segment": "SELECT segment, count(*) AS customers, CAST(sum(mrr) AS DOUBLE) AS total_mrr FROM customers GROUP BY 1",
    "active_products": """SELECT company_name, segment, count(subscription_id) AS products, CAST(sum(mrr_amount) AS DOUBLE) AS total_mrr
      FROM customers c JOIN subscriptions s ON c.customer_id = s.customer_id WHERE s.status = 'Active' GROUP BY 1, 2""",
    "customer_listing": """SELECT customer_id, company_name, segment, CAST(mrr AS DOUBLE) AS mrr, health_score, account_status, csm_owner, created_date,
      CAST(mrr * 12 AS DOUBLE) AS arr FROM customers""",
    "cohort_revenue": """SELECT CAST(date_trunc('month', start_date) AS DATE) AS cohort_month, segment, industry, product_name, plan_tier,
      count(DISTINCT subscription_id) AS subscription_count, CAST(sum(mrr_amount) AS DOUBLE) AS total_mrr, CAST(sum(arr_amount) AS DOUBLE) AS total_arr,
      round(CAST(sum(mrr_amount) AS DOUBLE) / count(*), 4) AS avg_mrr, count(DISTINCT CASE WHEN status = 'Cancelled' THEN subscription_id END) AS churned_subscriptions
      FROM subscriptions s JOIN customers c ON s.customer_id = c.customer_id GROUP BY 1, 2, 3, 4, 5""",
    "revenue_churn": f"""WITH {REVMONTH} SELECT * REPLACE (CAST(total_mrr AS DOUBLE) AS total_mrr, CAST(total_arr AS DOUBLE) AS total_arr,
      CAST(active_mrr AS DOUBLE) AS active_mrr, CAST(churned_mrr AS DOUBLE) AS churned_mrr) FROM rm""",
    "revenue_six_months": f"""WITH {REVMONTH} SELECT segment, product_name, CAST(sum(total_mrr) AS DOUBLE) AS total_mrr, CAST(sum(customer_count) AS BIGINT) AS customers
      FROM rm WHERE revenue_month >= DATE '2001-02-02' GROUP BY 1, 2""",
    "customer_360_faithful": f"""WITH h AS {NEWEST}, recent AS (SELECT ticket_id, customer_id FROM tickets WHERE created_date >= DATE '2024-01-31' - 90),
      act AS (SELECT * FROM subscriptions WHERE status = 'Active')
      SELECT c.customer_id, c.company_name, c.segment, c.industry, c.state, c.account_status, c.csm_owner, c.created_date AS customer_since,
        date_diff('month', c.created_date, DATE '2001-08-02') AS tenure_months, count(DISTINCT s.subscription_id) AS active_subscriptions,
        CAST(coalesce(sum(s.mrr_amount), 0) AS DOUBLE) AS total_mrr, CAST(coalesce(sum(s.arr_amount), 0) AS DOUBLE) AS total_arr,
        count(DISTINCT u.user_id) AS total_users, count(DISTINCT CASE WHEN u.user_status = 'Active' THEN u.user_id END) AS active_users,
        max(u.last_login_date) AS last_user_login, h.overall_health_score, h.churn_risk, count(DISTINCT t.ticket_id) AS total_tickets_90d
      FROM customers c LEFT JOIN act s ON c.customer_id = s.customer_id LEFT JOIN users u ON c.customer_id = u.customer_id
        LEFT JOIN h ON c.customer_id = h.customer_id LEFT JOIN recent t ON c.customer_id = t.customer_id GROUP BY ALL""",
    "customer_360": f"WITH {C360} SELECT * REPLACE (CAST(total_mrr AS DOUBLE) AS total_mrr, CAST(total_arr AS DOUBLE) AS total_arr) FROM c360",
    "executive_kpis": f"""WITH {C360} SELECT count(*) AS total_customers, count(*) FILTER (account_status = 'Active') AS active_customers,
      count(*) FILTER (account_status = 'Churned') AS churned_customers, round(count(*) FILTER (account_status = 'Churned') * 100.0::DOUBLE / count(*), 2) AS churn_rate_pct,
      CAST(sum(total_mrr) AS DOUBLE) AS total_mrr, CAST(sum(total_arr) AS DOUBLE) AS total_arr, round(CAST(sum(total_mrr) AS DOUBLE) / count(*), 2) AS avg_mrr_per_customer,
      count(*) FILTER (segment = 'BUILDING') AS building_customers, count(*) FILTER (segment = 'MACHINERY') AS machinery_customers,
      count(*) FILTER (segment = 'HOUSEHOLD') AS household_customers, round(CAST(sum(overall_health_score) AS DOUBLE) / count(overall_health_score), 4) AS avg_health_score,
      count(*) FILTER (churn_risk = 'Critical') AS critical_risk_customers, count(*) FILTER (churn_risk = 'High') AS high_risk_customers,
      round(CAST(sum(active_users) AS DOUBLE) / count(active_users), 4) AS avg_active_users,
      round(CAST(sum(days_since_last_login) AS DOUBLE) / count(days_since_last_login), 4) AS avg_days_since_login,
      round(CAST(sum(latest_nps_score) AS DOUBLE) / count(latest_nps_score), 4) AS avg_nps_score,
      count(*) FILTER (nps_category = 'Promoter') AS promoter_count, count(*) FILTER (nps_category = 'Detractor') AS detractor_count,
      DATE '2001-08-02' AS report_date FROM c360 WHERE account_status <> 'Trial'""",
    "health_dashboard": f"WITH {DASH} SELECT * FROM dash",
    "top_at_risk": f"""WITH {DASH} SELECT customer_id, company_name, segment, csm_owner, overall_health_score, churn_risk, mrr_at_risk, recommended_action
      FROM dash ORDER BY mrr_at_risk DESC, customer_id LIMIT 10""",
    "shared_customer_summary": f"WITH {SHARED} SELECT * REPLACE (CAST(mrr AS DOUBLE) AS mrr) FROM shared",
    "executive_metrics": f"""WITH {SHARED} SELECT count(DISTINCT customer_id) AS total_customers, CAST(sum(mrr) AS DOUBLE) AS total_mrr,
      round(CAST(sum(mrr) AS DOUBLE) / count(*), 2) AS avg_mrr, round(CAST(sum(overall_health_score) AS DOUBLE) / count(overall_health_score), 4) AS avg_health_score,
      count(*) FILTER (churn_risk = 'Critical') AS critical_risk_count, DATE '2001-08-02' AS report_date FROM shared""",
    "product_usage_month": """SELECT CAST(date_trunc('month', usage_date) AS DATE) AS usage_month, count(DISTINCT customer_id) AS active_customers,
      CAST(sum(emails_sent) AS BIGINT) AS total_emails, CAST(sum(social_posts) AS BIGINT) AS total_social_posts, CAST(sum(messages_sent) AS BIGINT) AS total_texts,
      round(CAST(sum(session_minutes) AS DOUBLE) / count(*), 4) AS avg_session_minutes FROM usage_daily GROUP BY 1""",
    "analytics_base_customer": f"WITH {CBASE} SELECT * FROM cbase",
    "analytics_base_revenue": f"WITH {RBASE} SELECT * EXCLUDE (mrr) FROM rbase",
    "analytics_base_usage": f"WITH {UBASE} SELECT * REPLACE (CAST(session_minutes AS DOUBLE) AS session_minutes) FROM ubase",
    "analytics_base_support": f"WITH {SBASE} SELECT * FROM sbase",
    "mrr_history": f"WITH {MRRH} SELECT month, CAST(total_mrr AS DOUBLE) AS total_mrr, customer_count, round(CAST(total_mrr AS DOUBLE) / customer_count, 2) AS arpu FROM mh",
    "daily_usage": f"WITH {DU} SELECT * FROM du",
    "mrr_change": f"WITH {CHANGE} SELECT * FROM chd",
    "mrr_change_top": f"WITH {CHANGE} SELECT * FROM chd WHERE abs(mrr_change) > 0 ORDER BY abs(mrr_change) DESC, segment, industry, product_name LIMIT 10",
    "new_mrr_compare": """WITH s AS (SELECT segment, industry, product_name, date_trunc('month', start_date) AS m, sum(mrr_amount) AS v
        FROM subscriptions JOIN customers USING (customer_id) GROUP BY ALL)
      SELECT segment, industry, product_name, CAST(coalesce(p.v, 0) AS DOUBLE) AS prior_value, CAST(coalesce(c.v, 0) AS DOUBLE) AS current_value,
        CAST(coalesce(c.v, 0) - coalesce(p.v, 0) AS DOUBLE) AS change,
        round(CAST(coalesce(c.v, 0) - coalesce(p.v, 0) AS DOUBLE) * 100.0 / nullif(CAST(coalesce(p.v, 0) AS DOUBLE), 0), 2) AS pct_change
      FROM (SELECT * FROM s WHERE m = DATE '2001-07-01') c FULL OUTER JOIN (SELECT * FROM s WHERE m = DATE '2001-06-01') p USING (segment, industry, product_name)""",
    "dashboard_sections": f"""WITH h AS {NEWEST}
      SELECT 'Key Metrics' AS section, '{{"active_customers":' || (SELECT count(*) FROM customers WHERE account_status = 'Active') || ',"total_mrr":' ||
        (SELECT sum(mrr_amount) FROM subscriptions WHERE status = 'Active') || ',"avg_health_score":' ||
        (SELECT round(CAST(sum(overall_health_score) AS DOUBLE) / count(*), 2) FROM h) || ',"at_risk_customers":' ||
        (SELECT count(DISTINCT customer_id) FROM h WHERE churn_risk IN ('High', 'Critical')) || '}}' AS data
      UNION ALL SELECT 'Segment Distribution', '{{' || string_agg('"' || segment || '":' || n, ',' ORDER BY segment) || '}}'
        FROM (SELECT segment, count(*) AS n FROM customers WHERE account_status = 'Active' GROUP BY 1)
      UNION ALL SELECT 'Product Revenue', '{{' || string_agg('"' || product_name || '":' || n, ',' ORDER BY product_name) || '}}'
        FROM (SELECT product_name, sum(mrr_amount) AS n FROM subscriptions WHERE status = 'Active' GROUP BY 1)
      UNION ALL SELECT 'Health Distribution', '{{' || string_agg('"' || churn_risk || '":' || n, ',' ORDER BY churn_risk) || '}}'
        FROM (SELECT churn_risk, count(DISTINCT customer_id) AS n FROM h GROUP BY 1)""",
    "key_metrics": f"""WITH h AS {NEWEST} SELECT (SELECT count(*) FROM customers WHERE account_status = 'Active') AS active_customers,
      (SELECT count(*) FROM customers WHERE account_status = 'Churned') AS churned_customers,
      (SELECT CAST(sum(mrr_amount) AS DOUBLE) FROM subscriptions WHERE status = 'Active') AS total_mrr,
      (SELECT round(CAST(sum(overall_health_score) AS DOUBLE) / count(*), 4) FROM h) AS avg_health_score,
      (SELECT round(CAST(sum(nps_score) AS DOUBLE) / count(*), 4) FROM feedback WHERE submitted_date >= DATE '2024-01-01') AS avg_nps,
      (SELECT count(*) FROM tickets WHERE status = 'Open') AS open_tickets""",
    "agent_usage": """SELECT agent_name, CAST(message_timestamp AS DATE) AS usage_date, count(DISTINCT conversation_id) AS conversations,
      count(*) FILTER (message_role = 'user') AS user_messages, count(*) FILTER (message_role = 'assistant') AS assistant_responses,
      count(DISTINCT user_id) AS unique_users FROM chats GROUP BY 1, 2""",
    "response_time": """SELECT conversation_id, user_id, agent_name, message_role, turn, left(message_content, 500) AS message_preview, message_timestamp,
      lag(message_timestamp) OVER w AS prev_message_time, date_diff('second', lag(message_timestamp) OVER w, message_timestamp) AS response_time_seconds
      FROM chats WINDOW w AS (PARTITION BY conversation_id ORDER BY message_timestamp, turn)""",
    "tvf_customer_360": f"""WITH {AGENT} SELECT customer_id, company_name AS customer_name, segment, industry, mrr, health_score, churn_risk, open_tickets,
      quiet AS last_login_days_ago FROM ag WHERE lower(company_name) LIKE '%customer#0000001%'""",
    "tvf_at_risk": f"""WITH {AGENT} SELECT company_name AS customer_name, segment, industry, mrr, health_score, churn_risk, health_trend, quiet AS days_since_login,
      CASE WHEN churn_risk = 'Critical' AND mrr > 500 THEN '{labels.RISK["high_value"]}'
           WHEN churn_risk = 'Critical' THEN '{labels.RISK["critical"]}'
           WHEN health_trend = 'Declining' THEN '{labels.RISK["declining"]}'
           WHEN quiet > 30 THEN '{labels.RISK["quiet"]}' ELSE '{labels.RISK["other"]}' END AS risk_summary
      FROM ag WHERE churn_risk IN ('High', 'Critical') AND mrr >= 0""",
    "tenant_extract": """SELECT c.customer_id, company_name, user_id, first_name, last_name, role, last_login_date, product_name, plan_tier, status AS subscription_status
      FROM customers c JOIN users u ON c.customer_id = u.customer_id JOIN subscriptions s ON c.customer_id = s.customer_id WHERE c.customer_id = 7""",
    "row_counts": """SELECT 'CUSTOMERS' AS table_name, count(*) AS row_count, min(created_date) AS earliest_date, max(created_date) AS latest_date FROM customers
      UNION ALL SELECT 'USERS', count(*), NULL, NULL FROM users
      UNION ALL SELECT 'SUBSCRIPTIONS', count(*), min(start_date), max(start_date) FROM subscriptions
      UNION ALL SELECT 'USAGE_DAILY', count(*), NULL, NULL FROM usage_daily UNION ALL SELECT 'HEALTH_SCORES', count(*), NULL, NULL FROM health_scores
      UNION ALL SELECT 'FEEDBACK', count(*), min(submitted_date), max(submitted_date) FROM feedback
      UNION ALL SELECT 'TICKETS', count(*), NULL, NULL FROM tickets UNION ALL SELECT 'CONVERSATIONS', count(*), NULL, NULL FROM conversations""",
    "total_records": "SELECT CAST(sum(n) AS BIGINT) AS total_records FROM ("
    + " UNION ALL ".join(f"SELECT count(*) AS n FROM {t}" for t in [*COUNTED, "conversations"]) + ")",
}
