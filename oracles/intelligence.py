"""SQL statements of forecasts, anomalies, metrics and verified questions."""

from oracles.products import CBASE, DU, MRRH, RBASE, SBASE, UBASE


def trend(key: str, source: str) -> str:
    return f"""s AS ({source}), p AS (SELECT {key}, month, CAST(v AS DOUBLE) AS y, CAST(year(month) * 12 + month(month) AS DOUBLE) AS x FROM s),
      f AS (SELECT {key}, max(month) AS last, max(x) AS lx, regr_slope(y, x) AS b, regr_intercept(y, x) AS a,
        sqrt(greatest(regr_syy(y, x) - regr_slope(y, x) * regr_sxy(y, x), 0) / nullif(count(*) - 2, 0)) AS sd FROM p GROUP BY 1),
      n AS (SELECT *, unnest(range(1, 7)) AS h FROM f)
      SELECT {key}, month, y AS actual, NULL AS forecast, NULL AS lower_bound, NULL AS upper_bound FROM p
      UNION ALL SELECT {key}, CAST(last + to_months(CAST(h AS INTEGER)) AS DATE), NULL, round(a + b * (lx + h), 2), round(a + b * (lx + h) - 1.96::DOUBLE * sd, 2), round(a + b * (lx + h) + 1.96::DOUBLE * sd, 2) FROM n"""


def anomaly(key: str, source: str) -> str:
    return f"""s AS ({source}), w AS (SELECT {key}, usage_date, CAST(v AS DOUBLE) AS y,
        avg(CAST(v AS DOUBLE)) OVER t AS e, stddev_samp(CAST(v AS DOUBLE)) OVER t AS sd, percent_rank() OVER (PARTITION BY {key} ORDER BY v) AS pr
        FROM s WINDOW t AS (PARTITION BY {key} ORDER BY usage_date ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING)),
      an AS (SELECT {key}, usage_date, y, round(e, 4) AS forecast, round((y - e) / nullif(sd, 0), 4) AS distance, round(pr, 4) AS percentile,
        coalesce(abs((y - e) / nullif(sd, 0)) > 2, false) AS is_anomaly FROM w)"""


def avg(c: str, n: int) -> str:
    return f"round(CAST(sum({c}) AS DOUBLE) / count({c}), {n})"


CUST = f"count(DISTINCT customer_id) AS customer_count, CAST(sum(mrr) AS DOUBLE) AS total_mrr, {avg('mrr', 2)} AS average_mrr, {avg('health_score', 4)} AS avg_health_score"
FEED = f"{avg('nps_score', 4)} AS avg_nps, count(*) FILTER (nps_score >= 9) AS promoter_count, count(*) FILTER (nps_score <= 6) AS detractor_count"
FB = "fb AS (SELECT f.*, segment, industry FROM feedback f LEFT JOIN (SELECT customer_id, segment, industry FROM customers) c ON f.customer_id = c.customer_id)"
LIVE = f"WITH {CBASE}, live AS (SELECT * FROM cbase WHERE account_status = 'Active') "
PAY = f"WITH {RBASE}, pay AS (SELECT * FROM rbase WHERE subscription_status = 'Active') "

SQL = {
    "mrr_forecast": f"WITH {MRRH}, {trend('series', 'SELECT $$all$$ AS series, month, total_mrr AS v FROM mh WHERE month < DATE $$2001-08-01$$')}",
    "product_forecast": "WITH " + trend("product_name", """SELECT product_name, CAST(date_trunc('month', start_date) AS DATE) AS month, sum(mrr_amount) AS v FROM subscriptions
        WHERE status = 'Active' AND start_date < DATE '2001-08-01' GROUP BY 1, 2"""),
    "login_anomalies": f"WITH {DU}, {anomaly('series', 'SELECT $$all$$ AS series, usage_date, total_logins AS v FROM du')} SELECT * FROM an",
    "flagged_anomalies": f"WITH {anomaly('event_type', 'SELECT event_type, CAST(ts AS DATE) AS usage_date, count(*) AS v FROM events GROUP BY 1, 2')} SELECT * FROM an WHERE is_anomaly",
    "metrics_by_segment": f"SELECT segment, customer_count, total_mrr, avg_health_score FROM (SELECT segment, {CUST} FROM customers GROUP BY 1)",
    "metrics_all_tables": f"""WITH {FB}, a AS (SELECT segment, industry, {CUST} FROM customers GROUP BY 1, 2), b AS (SELECT segment, industry, count(*) AS subscription_count
        FROM subscriptions JOIN customers USING (customer_id) GROUP BY 1, 2), c AS (SELECT segment, industry, {FEED} FROM fb GROUP BY 1, 2)
      SELECT segment, industry, customer_count, total_mrr, average_mrr, avg_health_score, subscription_count, avg_nps, promoter_count, detractor_count
      FROM a FULL OUTER JOIN b USING (segment, industry) FULL OUTER JOIN c USING (segment, industry)""",
    "metrics_by_synonym": f"""WITH {FB} SELECT segment, average_mrr, avg_nps FROM (SELECT segment, {CUST} FROM customers GROUP BY 1) FULL OUTER JOIN (SELECT segment, {FEED} FROM fb GROUP BY 1) USING (segment)""",
    "metrics_two_hops": f"""WITH {FB}, n AS (SELECT r_name AS industry, r_regionkey AS industry_no FROM region) SELECT industry_no, avg_nps, subscription_count FROM
      (SELECT industry_no, {FEED} FROM fb LEFT JOIN n USING (industry) GROUP BY 1) FULL OUTER JOIN
      (SELECT industry_no, count(*) AS subscription_count FROM subscriptions LEFT JOIN customers USING (customer_id) LEFT JOIN n USING (industry) GROUP BY 1) USING (industry_no)""",
    "facts_by_row": """SELECT product_name AS product, segment, r_regionkey AS industry_no, CAST(s.mrr_amount AS DOUBLE) AS subscription_mrr, CAST(c.mrr AS DOUBLE) AS customer_mrr, c.health_score
      FROM subscriptions s LEFT JOIN customers c ON s.customer_id = c.customer_id LEFT JOIN region ON r_name = c.industry""",
    "nps_metrics": f"WITH {FB} SELECT nps_category, segment, {FEED} FROM fb GROUP BY 1, 2",
    "subscription_metrics": """SELECT product_name AS product, status AS subscription_status, segment, count(*) AS subscription_count
      FROM subscriptions JOIN (SELECT customer_id, segment FROM customers) USING (customer_id) GROUP BY 1, 2, 3""",
    "segment_view_query": LIVE + f"SELECT customer_segment, count(*) AS customers, {avg('overall_health_score', 1)} AS avg_health FROM live GROUP BY 1",
    "product_view_query": PAY + "SELECT product_name, CAST(sum(mrr) AS DOUBLE) AS total_mrr, count(*) AS subscriptions FROM pay GROUP BY 1",
    "verified_01": LIVE + "SELECT count(*) AS active_customers FROM live",
    "verified_02": LIVE + "SELECT customer_segment, count(*) AS customer_count FROM live GROUP BY 1",
    "verified_03": LIVE + "SELECT customer_name, customer_segment, overall_health_score, churn_risk FROM live WHERE churn_risk = 'Critical'",
    "verified_04": LIVE + f"SELECT industry, {avg('overall_health_score', 1)} AS avg_health_score FROM live GROUP BY 1",
    "verified_05": PAY + "SELECT CAST(sum(mrr) AS DOUBLE) AS total_mrr FROM pay",
    "verified_06": PAY + "SELECT product_name, CAST(sum(mrr) AS DOUBLE) AS total_mrr FROM pay GROUP BY 1",
    "verified_07": PAY + "SELECT customer_segment, CAST(sum(mrr) AS DOUBLE) AS total_mrr, count(DISTINCT customer_id) AS customers FROM pay GROUP BY 1",
    "verified_08": PAY + "SELECT round(CAST(sum(mrr) AS DOUBLE) / count(DISTINCT customer_id), 2) AS avg_mrr_per_customer FROM pay",
    "verified_09": f"WITH {RBASE} SELECT CAST(sum(mrr) AS DOUBLE) AS churned_mrr FROM rbase WHERE subscription_status = 'Cancelled' AND subscription_end_date >= DATE '2001-08-01'",
    "verified_10": f"WITH {UBASE} SELECT CAST(sum(emails_sent) AS BIGINT) AS total_emails FROM ubase WHERE usage_month = DATE '2024-01-01'",
    "verified_11": f"WITH {UBASE} SELECT {avg('email_open_rate', 2)} AS avg_open_rate FROM ubase WHERE emails_sent > 0",
    "verified_12": f"WITH {UBASE} SELECT customer_name, CAST(sum(total_messages) AS BIGINT) AS total_messages FROM ubase GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
    "verified_13": f"WITH {UBASE} SELECT customer_segment, {avg('session_minutes', 1)} AS avg_session_minutes FROM ubase GROUP BY 1",
    "verified_14": f"WITH {SBASE} SELECT count(*) AS open_tickets FROM sbase WHERE ticket_status IN ('Open', 'In Progress')",
    "verified_15": f"WITH {SBASE} SELECT {avg('resolution_time_hours', 1)} AS avg_resolution_hours FROM sbase WHERE is_resolved = 1",
    "verified_16": f"WITH {SBASE} SELECT {avg('customer_satisfaction_score', 2)} AS avg_csat FROM sbase",
    "verified_17": f"WITH {SBASE} SELECT round(count(*) FILTER (sla_met) * 100.0::DOUBLE / count(*), 1) AS sla_met_pct FROM sbase",
}
