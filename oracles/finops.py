"""SQL statements of the usage, cost and budget reports."""

from tallyloom import labels

TM = "tm AS (SELECT * FROM metering WHERE start_time >= DATE '2024-01-01' AND warehouse_name LIKE 'WH%')"
CONFIG = """config(warehouse_name, credit_quota, team, budget_category) AS (VALUES ('WH_VIEW', 20000, 'Engineering', 'COMPUTE_DEV'),
  ('WH_CLICK', 50000, 'Operations', 'COMPUTE_PROD'), ('WH_PURCHASE', 120000, 'Analytics', 'COMPUTE_ANALYTICS'),
  ('WH_SIGNUP', 150000, 'Data Science', 'COMPUTE_ML'), ('WH_ERROR', 500000, 'Engineering', 'COMPUTE_ETL'))"""
QUOTA = f"""{TM}, {CONFIG}, quota AS (SELECT config.*, CAST(coalesce(u.used, 0) AS DOUBLE) AS used_credits FROM config
  LEFT JOIN (SELECT warehouse_name, sum(credits_used) AS used FROM tm GROUP BY 1) u USING (warehouse_name))"""
RULES = """rules(warehouse_name, threshold, action) AS (VALUES ('WH_VIEW', 75, 'NOTIFY'), ('WH_VIEW', 90, 'NOTIFY'), ('WH_VIEW', 100, 'SUSPEND'),
  ('WH_CLICK', 50, 'NOTIFY'), ('WH_CLICK', 75, 'NOTIFY'), ('WH_CLICK', 90, 'NOTIFY'), ('WH_CLICK', 100, 'NOTIFY'),
  ('WH_PURCHASE', 50, 'NOTIFY'), ('WH_PURCHASE', 75, 'NOTIFY'), ('WH_PURCHASE', 90, 'NOTIFY'), ('WH_PURCHASE', 100, 'SUSPEND'),
  ('WH_SIGNUP', 50, 'NOTIFY'), ('WH_SIGNUP', 75, 'NOTIFY'), ('WH_SIGNUP', 90, 'NOTIFY'), ('WH_SIGNUP', 95, 'SUSPEND'),
  ('WH_ERROR', 75, 'NOTIFY'), ('WH_ERROR', 90, 'NOTIFY'), ('WH_ERROR', 100, 'SUSPEND_IMMEDIATE'))"""
BUDGET = f"""{QUOTA}, budgets(budget_category, monthly_budget_credits, alert_threshold_pct, owner) AS (VALUES ('COMPUTE_DEV', 20000, 80, 'engineering'),
  ('COMPUTE_PROD', 110000, 80, 'operations'), ('COMPUTE_ANALYTICS', 120000, 80, 'analytics'), ('COMPUTE_ML', 150000, 80, 'science'),
  ('COMPUTE_ETL', 500000, 80, 'engineering'), ('STORAGE', 5000000, 80, 'engineering'), ('SERVERLESS', 2000, 80, 'engineering'), ('AI', 300, 80, 'science')),
 spent AS (SELECT budget_category, used_credits AS c FROM quota
  UNION ALL SELECT 'STORAGE', (CAST(sum(storage_bytes) AS DOUBLE) / count(*) + CAST(sum(stage_bytes) AS DOUBLE) / count(*) + CAST(sum(failsafe_bytes) AS DOUBLE) / count(*))
    / 1099511627776.0::DOUBLE * 23 FROM storage_daily WHERE usage_date >= DATE '2024-01-01'
  UNION ALL SELECT 'SERVERLESS', CAST(sum(rows_inserted) AS DOUBLE) / 1000 FROM refresh_log WHERE refresh_start_time >= DATE '2024-01-01'),
 b AS (SELECT budgets.*, coalesce(c, 0.0::DOUBLE) AS used, coalesce(c, 0.0::DOUBLE) / 31 * 31 AS pace FROM budgets LEFT JOIN spent USING (budget_category)),
 dash AS (SELECT budget_category, monthly_budget_credits, monthly_budget_credits * 3 AS monthly_budget_usd, round(used, 4) AS mtd_credits_used, round(used * 3, 2) AS mtd_cost_usd,
  round(monthly_budget_credits - used, 2) AS remaining_credits, round(used / monthly_budget_credits * 100, 2) AS pct_budget_used, round(pace, 2) AS projected_credits,
  round(pace * 3, 2) AS projected_cost_usd, CASE WHEN used / monthly_budget_credits >= 1.0 THEN '{labels.BUDGET["over"]}'
    WHEN used / monthly_budget_credits >= alert_threshold_pct / 100.0::DOUBLE THEN '{labels.BUDGET["risk"]}' WHEN pace > monthly_budget_credits THEN '{labels.BUDGET["projected"]}' ELSE '{labels.BUDGET["fine"]}' END AS budget_status,
  owner FROM b)"""

def spend(log: str, period: str, where: str) -> str:
    return f"""WITH {CONFIG}, s AS (SELECT CAST(date_trunc('{period}', start_time) AS DATE) AS period, coalesce(budget_category, 'OTHER_COMPUTE') AS category, sum(credits_used) AS c
        FROM {log} LEFT JOIN config USING (warehouse_name) WHERE {where} GROUP BY 1, 2), p AS (SELECT *, lag(c) OVER (PARTITION BY category ORDER BY period) AS prev FROM s)
      SELECT period, category, CAST(c AS DOUBLE) AS credits_used, CAST(c * 3 AS DOUBLE) AS estimated_cost_usd, CAST(prev AS DOUBLE) AS prev_credits,
        round(CAST(c - prev AS DOUBLE) * 100.0 / nullif(CAST(prev AS DOUBLE), 0), 2) AS pct_change FROM p"""


SQL = {
    "running_usage": f"""WITH {TM} SELECT warehouse_name, CAST(start_time AS DATE) AS usage_date, CAST(sum(credits_used) AS DOUBLE) AS daily_credits,
      CAST(sum(sum(credits_used)) OVER (PARTITION BY warehouse_name ORDER BY CAST(start_time AS DATE)) AS DOUBLE) AS cumulative_credits FROM tm GROUP BY 1, 2""",
    "usage_cost": f"""WITH {TM} SELECT warehouse_name, CAST(sum(credits_used) AS DOUBLE) AS total_credits, CAST(sum(credits_used) * 3 AS DOUBLE) AS estimated_cost_usd,
      max(end_time) AS last_usage FROM tm GROUP BY 1""",
    "quota_status": f"""WITH {QUOTA} SELECT warehouse_name, credit_quota, used_credits, round(credit_quota - used_credits, 2) AS remaining_credits,
      round(used_credits / credit_quota * 100, 2) AS pct_used, CASE WHEN used_credits / credit_quota >= 0.9 THEN '{labels.QUOTA["critical"]}' WHEN used_credits / credit_quota >= 0.75 THEN '{labels.QUOTA["warning"]}'
        WHEN used_credits / credit_quota >= 0.5 THEN '{labels.QUOTA["on_track"]}' ELSE '{labels.QUOTA["healthy"]}' END AS status,
      round(used_credits / 31 * 31, 0) AS projected_monthly_credits,
      CASE WHEN round(used_credits / 31 * 31, 0) > credit_quota THEN '{labels.PROJECTION["over"]}' ELSE '{labels.PROJECTION["within"]}' END AS projection_status FROM quota""",
    "thresholds": f"""WITH {QUOTA}, {RULES} SELECT q.warehouse_name, q.credit_quota, round(q.used_credits / q.credit_quota * 100, 2) AS pct_used, r.threshold, coalesce(r.action, 'NONE') AS action
      FROM quota q LEFT JOIN (SELECT q2.warehouse_name, threshold, action FROM quota q2 JOIN rules USING (warehouse_name) WHERE used_credits / credit_quota * 100 >= threshold
        QUALIFY row_number() OVER (PARTITION BY q2.warehouse_name ORDER BY threshold DESC) = 1) r ON q.warehouse_name = r.warehouse_name""",
    "budget_dashboard": f"WITH {BUDGET} SELECT * FROM dash",
    "budget_alerts": f"""WITH {BUDGET} SELECT DATE '2024-01-31' AS alert_date, budget_category, pct_budget_used AS pct_used, budget_status AS status,
      budget_category || ' is at ' || printf('%.2f', pct_budget_used) || '% of monthly budget. Status: ' || budget_status AS alert_message
      FROM dash WHERE pct_budget_used >= 75 OR budget_status LIKE '%OVER%'""",
    "alert_log": f"""WITH {BUDGET} SELECT DATE '2024-01-31' AS alert_date, budget_category, pct_budget_used AS pct_used, budget_status AS status,
      budget_category || ' is at ' || printf('%.2f', pct_budget_used) || '% of monthly budget. Status: ' || budget_status AS alert_message
      FROM dash WHERE pct_budget_used >= 75 OR budget_status LIKE '%OVER%'""",
    "spend_mom": spend("metering", "week", "true"),
    "spend_by_month": spend("long_metering", "month", "start_time >= DATE '2000-08-01'"),
    "cost_anomaly": f"""WITH d AS (SELECT CAST(start_time AS DATE) AS usage_date, warehouse_name, sum(credits_used) AS v FROM metering WHERE start_time >= DATE '2024-01-31' - 30 GROUP BY 1, 2),
      s AS (SELECT warehouse_name, CAST(sum(v) AS DOUBLE) / count(*) AS a, stddev_samp(CAST(v AS DOUBLE)) AS sd FROM d WHERE usage_date < DATE '2024-01-31' GROUP BY 1)
      SELECT usage_date, warehouse_name, round(CAST(v AS DOUBLE), 2) AS daily_credits, round(a, 2) AS avg_daily_credits, round(sd, 2) AS stddev_credits,
        round((CAST(v AS DOUBLE) - a) / nullif(sd, 0), 2) AS z_score,
        CASE WHEN abs((CAST(v AS DOUBLE) - a) / nullif(sd, 0)) > 3 THEN '{labels.ANOMALY["extreme"]}' WHEN abs((CAST(v AS DOUBLE) - a) / nullif(sd, 0)) > 2 THEN '{labels.ANOMALY["high"]}' ELSE '{labels.ANOMALY["normal"]}' END AS anomaly_level
      FROM d JOIN s USING (warehouse_name) WHERE CAST(v AS DOUBLE) > a + sd""",
    "team_share": f"""WITH {CONFIG}, t AS (SELECT CAST(date_trunc('month', start_time) AS DATE) AS month, team, sum(credits_used) AS c FROM metering JOIN config USING (warehouse_name) GROUP BY 1, 2)
      SELECT month, team, CAST(c AS DOUBLE) AS total_credits, CAST(c * 3 AS DOUBLE) AS total_cost_usd,
        round(CAST(c AS DOUBLE) * 100.0 / CAST(sum(c) OVER (PARTITION BY month) AS DOUBLE), 2) AS pct_of_total FROM t""",
    "storage_trend": """SELECT usage_date, round(CAST(storage_bytes AS DOUBLE) / 1099511627776.0::DOUBLE, 4) AS storage_tb, round(CAST(stage_bytes AS DOUBLE) / 1099511627776.0::DOUBLE, 4) AS stage_tb,
      round(CAST(failsafe_bytes AS DOUBLE) / 1099511627776.0::DOUBLE, 4) AS failsafe_tb,
      round(CAST(storage_bytes + stage_bytes + failsafe_bytes AS DOUBLE) / 1099511627776.0::DOUBLE, 4) AS total_tb FROM storage_daily WHERE usage_date >= DATE '2024-01-31' - 90""",
    "storage_by_database": """SELECT table_catalog AS database_name, round(CAST(sum(active_bytes) AS DOUBLE) / 1073741824.0::DOUBLE, 2) AS active_gb,
      round(CAST(sum(time_travel_bytes) AS DOUBLE) / 1073741824.0::DOUBLE, 2) AS time_travel_gb, round(CAST(sum(failsafe_bytes) AS DOUBLE) / 1073741824.0::DOUBLE, 2) AS failsafe_gb,
      round(CAST(sum(active_bytes + time_travel_bytes + failsafe_bytes) AS DOUBLE) / 1073741824.0::DOUBLE, 2) AS total_gb FROM table_storage GROUP BY 1""",
    "largest_tables": """SELECT table_catalog AS database_name, table_schema, table_name, round(CAST(active_bytes AS DOUBLE) / 1073741824.0::DOUBLE, 4) AS active_gb,
      round(CAST(time_travel_bytes AS DOUBLE) / 1073741824.0::DOUBLE, 4) AS time_travel_gb, row_count FROM table_storage ORDER BY active_bytes DESC, table_catalog, table_name LIMIT 20""",
    "share_usage": "SELECT * FROM share_usage WHERE share_name LIKE 'SHARE%'",
}
