"""SQL statements of the generators: the same draws, written out."""

from tallyloom.plans import generators as g

def below(key: str, salt: int, n: int) -> str:
    return f"(CAST('0x' || left(md5(CAST({key} AS VARCHAR) || ':{salt}'), 12) AS BIGINT) % {n})"


def between(key: str, salt: int, low: int, high: int) -> str:
    return f"({low} + {below(key, salt, high - low + 1)})"


def nth(values: list, index: str) -> str:
    quoted = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)
    return f"([{quoted}])[1 + {index}]"


def pick(key: str, salt: int, values: list) -> str:
    return nth(values, below(key, salt, len(values)))


def ago(days: str) -> str:
    return f"(DATE '2024-01-31' - CAST({days} AS INTEGER))"


def pad(prefix: str, number: str, width: int) -> str:
    return f"('{prefix}' || lpad(CAST({number} AS VARCHAR), CAST(greatest({width}, length(CAST({number} AS VARCHAR))) AS INTEGER), '0'))"


def named(prefix: str, key: str) -> str:
    return f"('{prefix}' || {key})"


SPREAD = between("k", 9, 0, 7999)
CUSTOMERS = f"""gc AS (SELECT k, {pad('C', 'k', 9)} AS customer_id, {pick('k', 1, g.PREFIXES)} || ' ' || {pick('k', 2, g.MIDDLES)} || ' ' || {pick('k', 3, g.SUFFIXES)} AS company_name, segment,
   {pick('k', 5, g.INDUSTRIES)} AS industry, {pick('k', 6, g.STATES)} AS state,
   CAST(CASE segment WHEN 'Enterprise' THEN 2000 + {SPREAD} WHEN 'Mid-Market' THEN 500 + {SPREAD} % 2000 ELSE 99 + {SPREAD} % 701 END AS INTEGER) AS mrr,
   {below('k', 7, 101)} AS health_score, {ago(between('k', 8, 1, 1500))} AS created_date FROM (SELECT c_custkey AS k, {pick('c_custkey', 4, g.SEGMENTS)} AS segment FROM customer))"""
U = "(k || '-' || n)"
SS = between(U, 33, 0, 2499)
DRAW = below("k", 53, 100)
STAR = f"""{CUSTOMERS}, st AS (SELECT k, customer_id, company_name, segment, industry, state, created_date, {pick('k', 51, g.CHANNELS)} AS acquisition_channel, 'Desk ' || {below('k', 52, 10)} AS csm_owner,
   CASE WHEN {DRAW} < 78 THEN 'Active' WHEN {DRAW} < 88 THEN 'Churned' WHEN {DRAW} < 94 THEN 'Paused' ELSE 'Trial' END AS account_status, {below('k', 54, 100)} < 15 AS is_strategic_account,
   CASE segment WHEN 'SMB' THEN {pick('k', 55, ['1-5', '6-20'])} WHEN 'Mid-Market' THEN {pick('k', 55, ['21-50', '51-100'])} ELSE '100+' END AS employee_count_band FROM gc)"""
MEMBERS = f"""{STAR}, su0 AS (SELECT *, unnest(range(1, 1 + CASE segment WHEN 'SMB' THEN {between('k', 60, 2, 5)} WHEN 'Mid-Market' THEN {between('k', 60, 4, 8)} ELSE {between('k', 60, 6, 15)} END)) AS n FROM st),
  mem AS (SELECT {U} AS u, k, {named('USER-', U)} AS user_id, customer_id, {pick(U, 61, g.FIRST)} AS first_name, {pick(U, 62, g.LAST)} AS last_name, {pick(U, 63, g.ROLES)} AS role,
   created_date + CAST({between(U, 64, 0, 365)} AS INTEGER) AS created_date,
   CASE WHEN account_status = 'Active' THEN {ago(between(U, 65, 0, 30))} ELSE {ago(between(U, 65, 30, 180))} END AS last_login_date, {between(U, 66, 5, 500)} AS login_count, n = 1 AS is_primary_contact,
   CASE WHEN account_status = 'Active' AND {below(U, 67, 100)} < 92 THEN 'Active' ELSE 'Inactive' END AS user_status, {below(U, 68, 100)} < 70 AS mfa_enabled FROM su0)"""
E = "(u || '-' || d)"
H = "(k || '-' || w)"
TD = below("u", 112, 100)
LD = below("k", 122, 100)
LEADS = f"""ld AS (SELECT k, {pad('LEAD-', 'k', 9)} AS lead_id, {pick('k', 120, g.PREFIXES)} || ' ' || {pick('k', 121, g.SUFFIXES)} AS company_name, {pick('k', 123, g.CHANNELS)} AS lead_source,
   {ago(between('k', 124, 0, 365))} AS created_date, CASE WHEN {LD} < 24 THEN 'New' WHEN {LD} < 42 THEN 'Contacted' WHEN {LD} < 67 THEN 'Qualified' WHEN {LD} < 81 THEN 'Converted' ELSE 'Unqualified' END AS lead_status,
   CASE WHEN {below('k', 125, 10)} < 6 THEN {ago(between('k', 126, 0, 365))} END AS mql_date FROM (SELECT c_custkey AS k FROM customer))"""
OFF = f"CASE WHEN segment = 'Enterprise' THEN {between(U, 73, 10, 25)} ELSE 0 END"
PRICE = between(U, 72, 49, 899)
START = f"(created_date + CAST({between(U, 74, 0, 90)} AS INTEGER))"

SQL = {
    "gen_customers": f"WITH {CUSTOMERS} SELECT * EXCLUDE (k) FROM gc",
    "gen_users": f"""WITH {CUSTOMERS}, x AS (SELECT *, unnest(range(1, 3 + {below('k', 20, 2)})) AS n FROM gc)
      SELECT {pad('U', 'row_number() OVER (ORDER BY customer_id, n)', 9)} AS user_id, customer_id, lower({pick(U, 21, g.FIRST)}) || '.' || lower({pick(U, 22, g.LAST)}) || '@' ||
        left(lower(replace(company_name, ' ', '')), 15) || '.com' AS email, '(' || {between(U, 24, 100, 999)} || ') ' || {between(U, 25, 100, 999)} || '-' || {between(U, 26, 1000, 9999)} AS phone,
        {pick(U, 21, g.FIRST)} || ' ' || {pick(U, 22, g.LAST)} AS full_name, {pick(U, 23, g.ROLES)} AS role FROM x""",
    "gen_subscriptions": f"""WITH {CUSTOMERS}, x AS (SELECT *, unnest([1, 2]) AS n FROM gc) SELECT {named('S', U)} AS subscription_id, customer_id, {pick(U, 31, g.PRODUCTS)} AS product,
      CAST(CASE segment WHEN 'Enterprise' THEN 500 + {SS} WHEN 'Mid-Market' THEN 200 + {SS} % 800 ELSE 50 + {SS} % 350 END AS INTEGER) AS mrr, {pick(U, 32, g.STATUSES)} AS status,
      created_date + CAST({between(U, 34, 0, 29)} AS INTEGER) AS start_date FROM x""",
    "gen_feedback": f"""WITH {CUSTOMERS}, x AS (SELECT *, {between('k', 41, 1, 10)} AS nps_score FROM gc WHERE {below('k', 40, 100)} <= 50) SELECT {pad('F', 'k', 9)} AS feedback_id, customer_id, nps_score,
      CASE WHEN nps_score >= 9 THEN {pick('k', 43, g.PRAISE)} WHEN nps_score >= 7 THEN {pick('k', 43, g.NEUTRAL)} ELSE {pick('k', 43, g.BLAME)} END AS feedback_text, {ago(between('k', 42, 1, 365))} AS submitted_date FROM x""",
    "gen_star_customers": f"WITH {STAR} SELECT * EXCLUDE (k) FROM st",
    "gen_star_users": f"WITH {MEMBERS} SELECT * EXCLUDE (k, u) FROM mem",
    "gen_star_subscriptions": f"""WITH {STAR}, x AS (SELECT *, unnest(range(1, 1 + CASE segment WHEN 'Enterprise' THEN 4 WHEN 'Mid-Market' THEN 3 ELSE 2 END)) AS n FROM st)
      SELECT {named('SUB-', U)} AS subscription_id, customer_id, {nth(g.PRODUCTS, f"({below('k', 71, 6)} + n) % 6")} AS product_name, {pick(U, 75, g.TIERS)} AS plan_tier,
        CASE WHEN {below(U, 76, 100)} < 70 THEN 'Annual' ELSE 'Monthly' END AS billing_frequency, {START} AS start_date,
        CASE WHEN account_status = 'Churned' THEN CAST({START} + to_months(CAST({between(U, 77, 3, 24)} AS INTEGER)) AS DATE) END AS end_date,
        CASE account_status WHEN 'Churned' THEN 'Cancelled' WHEN 'Paused' THEN 'Pending' ELSE 'Active' END AS status,
        {PRICE} * (100 - {OFF}) AS mrr_cents, {PRICE} * (100 - {OFF}) * 12 AS arr_cents, {OFF} AS discount_percent FROM x""",
    "gen_star_usage": f"""WITH {MEMBERS}, x AS (SELECT *, unnest(range(0, 90)) AS d FROM mem WHERE user_status = 'Active'), y AS (SELECT *, {ago('d')} AS dt FROM x WHERE {below(E, 80, 10)} < 7)
      SELECT dt AS usage_date, customer_id, user_id, CASE WHEN dayofweek(dt) + 1 IN (3, 5) THEN {between(E, 81, 0, 50)} ELSE {between(E, 81, 0, 20)} END AS emails_sent,
        CASE WHEN dayofweek(dt) + 1 IN (1, 7) THEN 0 ELSE {between(E, 82, 0, 8)} END AS social_posts_published, {between(E, 83, 1, 10)} AS total_logins, {between(E, 84, 5, 120)} AS session_duration_minutes FROM y""",
    "gen_star_health": f"""WITH {STAR}, x AS (SELECT *, unnest(range(0, 12)) AS w FROM st WHERE account_status IN ('Active', 'Paused')),
      y AS (SELECT customer_id, CAST(date_trunc('week', DATE '2024-01-31') AS DATE) - CAST(w * 7 AS INTEGER) AS snapshot_date, {between(H, 91, 40, 100)} AS usage_score, {between(H, 92, 30, 100)} AS engagement_score,
        {between(H, 93, 50, 100)} AS support_score, {between(H, 94, 60, 100)} AS payment_score, {between(H, 95, 20, 100)} AS expansion_score, {pick(H, 96, ['Improving', 'Stable', 'Declining'])} AS health_trend FROM x),
      z AS (SELECT *, (usage_score * 25 + engagement_score * 20 + support_score * 20 + payment_score * 20 + expansion_score * 15 + 50) // 100 AS overall_health_score FROM y)
      SELECT *, CASE WHEN overall_health_score >= 80 THEN 'Low' WHEN overall_health_score >= 60 THEN 'Medium' WHEN overall_health_score >= 40 THEN 'High' ELSE 'Critical' END AS churn_risk FROM z""",
    "gen_star_nps": f"""WITH {MEMBERS}, x AS (SELECT *, {between('u', 101, 0, 10)} AS nps_score FROM mem WHERE is_primary_contact AND {below('u', 100, 10)} < 3)
      SELECT {named('NPS-', 'u')} AS response_id, customer_id, user_id, {ago(between('u', 102, 0, 365))} AS survey_date, nps_score,
        CASE WHEN nps_score <= 6 THEN 'Detractor' WHEN nps_score <= 8 THEN 'Passive' ELSE 'Promoter' END AS nps_category,
        CASE WHEN {below('u', 103, 10)} < 4 THEN NULL ELSE {pick('u', 104, g.PRAISE + g.NEUTRAL + g.BLAME)} END AS feedback_text FROM x""",
    "gen_star_tickets": f"""WITH {MEMBERS} SELECT {named('TKT-', 'u')} AS ticket_id, customer_id, user_id, {ago(between('u', 111, 0, 365))} AS created_date, {pick('u', 113, g.CATEGORIES)} AS category,
      {pick('u', 114, ['Medium'] * 5 + ['Low'] * 3 + ['High', 'Urgent'])} AS priority,
      CASE WHEN {TD} < 58 THEN 'Resolved' WHEN {TD} < 74 THEN 'Closed' WHEN {TD} < 86 THEN 'In Progress' WHEN {TD} < 93 THEN 'Waiting on Customer' ELSE 'Open' END AS status,
      {between('u', 115, 1, 72)} AS resolution_time_hours, {between('u', 116, 1, 5)} AS csat_score, {below('u', 117, 100)} < 92 AS sla_met,
      'Question about ' || lower({pick('u', 113, g.CATEGORIES)}) AS ticket_summary FROM mem WHERE {below('u', 110, 10)} < 4""",
    "gen_star_leads": f"WITH {LEADS} SELECT * EXCLUDE (k) FROM ld",
    "gen_star_opportunities": f"""WITH {LEADS}, x AS (SELECT *, {nth([s for s, _ in g.PIPELINE], below('k', 131, 6))} AS stage FROM ld WHERE lead_status IN ('Qualified', 'Converted') AND {below('k', 130, 10)} < 8)
      SELECT {pad('OPP-', 'k', 9)} AS opportunity_id, lead_id, company_name || ' - ' || {pick('k', 132, g.DEALS)} AS opportunity_name, stage,
        {nth([p for _, p in g.PIPELINE], below('k', 131, 6))} AS probability, {between('k', 133, 5000, 100000)} AS amount, created_date + CAST({between('k', 134, 30, 120)} AS INTEGER) AS close_date,
        CASE WHEN stage IN ('Won', 'Lost') THEN created_date + CAST({between('k', 135, 30, 90)} AS INTEGER) END AS actual_close_date FROM x""",
    "gen_batch": f"""SELECT {pad('N', 'c_custkey', 9)} AS customer_id, {nth(g.SEGMENTS, 'c_custkey % 3')} AS segment, 1000 + c_custkey * 123 % 5000 AS mrr,
      'monthly_batch_load' AS _source_system, 'batch_2024_004' AS _batch_id FROM customer""",
}
