"""SQL statements of the log analytics."""

QH = "qh AS (SELECT * FROM query_history WHERE start_time >= DATE '2024-01-31' - 30 AND warehouse_name LIKE 'WH%')"
LG = "lg AS (SELECT * FROM logins WHERE event_timestamp >= DATE '2024-01-31' - 30)"
def since(days: int, at: str = "query_start_time") -> str:
    return f"{at} >= DATE '2001-08-02' - {days} AND {at} <= DATE '2001-08-02'"


SINCE = since(30)
ROLES = f"""rd AS (SELECT object_name, count(*) AS read_count, count(DISTINCT user_name) AS unique_users, max(query_start_time) AS last_read FROM direct_access WHERE {SINCE} GROUP BY 1),
  wr AS (SELECT object_name, count(*) AS write_count, max(query_start_time) AS last_write FROM modified WHERE {SINCE} GROUP BY 1),
  roles AS (SELECT coalesce(rd.object_name, wr.object_name) AS table_name, coalesce(read_count, 0) AS reads_30d, coalesce(unique_users, 0) AS unique_readers,
    coalesce(write_count, 0) AS writes_30d, last_read, last_write,
    CASE WHEN write_count IS NULL THEN 'SOURCE' WHEN read_count IS NULL THEN 'TARGET' ELSE 'INTERMEDIATE' END AS table_role
    FROM rd FULL OUTER JOIN wr ON rd.object_name = wr.object_name)"""
COLS = """cols AS (SELECT l_shipdate AS query_start_time, 'user_' || l_suppkey AS user_name, 'PROD.RAW.PART_' || (l_partkey % 25) AS table_name,
    unnest(['brand', 'c' || l_linenumber]) AS column_name FROM lineitem
  UNION ALL SELECT l_shipdate, 'user_' || l_suppkey, 'PROD.RAW.USERS_' || (l_suppkey % 4), 'email' FROM lineitem)"""
DEPS = """SELECT referencing_database || '.' || referencing_schema || '.' || referencing_object_name AS dependent_object, referencing_object_domain AS object_type
  FROM dependencies WHERE referenced_object_name = 'PART_7'"""

SQL = {
    "top_queries": f"""WITH {QH} SELECT query_id, query_type, user_name, role_name, warehouse_name, warehouse_size, round(CAST(total_elapsed_time AS DOUBLE) / 1000, 2) AS elapsed_seconds,
      CAST(credits_used AS DOUBLE) AS cloud_credits, rows_produced, CAST(bytes_scanned AS DOUBLE) / 1073741824.0::DOUBLE AS gb_scanned, left(query_text, 200) AS query_preview
      FROM qh ORDER BY total_elapsed_time DESC, query_id LIMIT 20""",
    "volume_by_user": f"""WITH {QH} SELECT user_name, role_name, count(*) AS query_count, count(*) FILTER (execution_status = 'SUCCESS') AS successful_queries,
      count(*) FILTER (execution_status = 'FAIL') AS failed_queries, round(CAST(sum(total_elapsed_time) AS DOUBLE) / count(*) / 1000, 2) AS avg_elapsed_seconds,
      round(CAST(sum(bytes_scanned) AS DOUBLE) / 1099511627776.0::DOUBLE, 4) AS total_tb_scanned FROM qh GROUP BY 1, 2 ORDER BY query_count DESC, user_name, role_name LIMIT 20""",
    "hour_weekday": f"""WITH {QH} SELECT CAST(hour(start_time) AS INTEGER) AS hour_of_day, left(dayname(start_time), 3) AS day_of_week, count(*) AS query_count,
      round(CAST(sum(total_elapsed_time) AS DOUBLE) / count(*) / 1000, 4) AS avg_seconds FROM qh GROUP BY 1, 2""",
    "off_hours": f"""WITH {QH} SELECT CAST(start_time AS DATE) AS access_date, user_name, count(*) AS query_count, 'Off-Hours Access' AS check_name
      FROM qh WHERE hour(start_time) < 6 OR hour(start_time) > 22 GROUP BY 1, 2""",
    "query_text_search": """SELECT query_id, query_type, warehouse_size, start_time, round(CAST(total_elapsed_time AS DOUBLE) / 1000, 2) AS seconds
      FROM query_history WHERE start_time >= DATE '2024-01-31' - 7 AND query_text ILIKE '%FROM T WHERE%' AND query_text NOT ILIKE '%INFORMATION_SCHEMA%'""",
    "recent_access": f"""SELECT l_orderkey AS query_id, l_shipdate AS query_start_time, 'user_' || l_suppkey AS user_name, 2 AS objects_read,
      CASE l_returnflag WHEN 'R' THEN 2 WHEN 'A' THEN 1 ELSE 0 END AS objects_written FROM lineitem WHERE {since(7, 'l_shipdate')}""",
    "object_access": f"""SELECT CAST(query_start_time AS DATE) AS access_date, user_name, object_name AS object_accessed, count(*) AS access_count, 'Review for compliance' AS audit_note
      FROM direct_access WHERE {SINCE} AND object_name LIKE '%USERS%' GROUP BY 1, 2, 3""",
    "object_modified": f"SELECT query_id, query_start_time, user_name, object_name AS table_modified, columns_modified FROM modified WHERE {SINCE}",
    "column_access": f"WITH {COLS} SELECT table_name, column_name, count(*) AS access_count FROM cols WHERE {SINCE} GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 30",
    "column_access_rows": f"WITH {COLS} SELECT * FROM cols WHERE {since(1)} ORDER BY query_start_time DESC, user_name, table_name, column_name LIMIT 100",
    "table_reads": f"""SELECT CAST(query_start_time AS DATE) AS access_date, object_name AS source_table, count(*) AS read_count, count(DISTINCT user_name) AS unique_users
      FROM direct_access WHERE {SINCE} AND object_name LIKE 'PROD.RAW.%' GROUP BY 1, 2""",
    "flow_counts": f"""SELECT source_table, target_table, count(*) AS write_count, max(query_start_time) AS last_write FROM flows
      WHERE {SINCE} AND source_table LIKE 'PROD.RAW.%' GROUP BY 1, 2""",
    "flow_edges": f"SELECT DISTINCT source_table AS source_node, target_table AS target_node, 'data_flow' AS edge_type FROM flows WHERE {SINCE} AND source_table <> target_table",
    "lineage_roles": f"WITH {ROLES} SELECT * FROM roles",
    "flow_nodes": f"""WITH {ROLES} SELECT DISTINCT table_name AS node_id, split_part(table_name, '.', 1) AS database_name, split_part(table_name, '.', 2) AS schema_name,
      split_part(table_name, '.', 3) AS object_name, table_role AS node_type FROM roles""",
    "dependencies": """SELECT referencing_object_name AS view_name, referencing_object_domain AS view_type, referenced_object_name AS depends_on_table,
      referenced_object_domain AS depends_on_type FROM dependencies""",
    "dependents": DEPS,
    "impact": f"""SELECT 'VIEW' AS object_type, dependent_object AS object_name, 'Direct reference in view definition' AS impact FROM ({DEPS})
      UNION ALL SELECT 'QUERY', user_name || ' queries', count(*) || ' queries in period' FROM direct_access WHERE {SINCE} AND object_name = 'PROD.RAW.PART_7' GROUP BY user_name""",
    "logins": "SELECT * FROM logins WHERE event_timestamp >= DATE '2024-01-31' - 7 ORDER BY event_timestamp DESC, event_id LIMIT 100",
    "failed_logins": f"""WITH {LG} SELECT CAST(event_timestamp AS DATE) AS login_date, user_name, client_ip, error_code, error_message, count(*) AS failed_attempts
      FROM lg WHERE is_success = 'NO' GROUP BY 1, 2, 3, 4, 5 ORDER BY failed_attempts DESC, login_date, user_name, client_ip, error_code LIMIT 20""",
    "mfa_by_user": f"""WITH {LG} SELECT user_name, max(event_timestamp) AS last_login, count(*) FILTER (second_authentication_factor IS NULL) AS logins_without_mfa, count(*) AS total_logins,
      round(count(*) FILTER (second_authentication_factor IS NULL) * 100.0::DOUBLE / count(*), 2) AS pct_without_mfa
      FROM lg WHERE is_success = 'YES' GROUP BY 1 HAVING count(*) FILTER (second_authentication_factor IS NULL) > 0""",
    "mfa": f"""WITH {LG} SELECT 'MFA Compliance' AS check_name, count(second_authentication_factor) AS with_mfa, count(*) - count(second_authentication_factor) AS without_mfa,
      round(count(second_authentication_factor) * 100.0::DOUBLE / count(*), 2) AS mfa_pct FROM lg WHERE is_success = 'YES'""",
    "directory": """SELECT user_name, email, default_role, created_on, last_success_login, date_diff('day', last_success_login, DATE '2024-01-31') AS days_since_login
      FROM directory WHERE deleted_on IS NULL""",
    "inactivity": """SELECT user_name, email, default_role, last_success_login, date_diff('day', last_success_login, DATE '2024-01-31') AS days_inactive
      FROM directory WHERE deleted_on IS NULL AND last_success_login < DATE '2024-01-31' - 90""",
    "role_review": """SELECT 'High Privilege Users' AS check_name, user_name AS grantee_name, default_role AS role, granted_by, created_on FROM directory
      WHERE default_role IN ('ACCOUNTADMIN', 'SECURITYADMIN', 'SYSADMIN') AND deleted_on IS NULL""",
    "role_membership": """SELECT user_name AS user_or_role, default_role AS granted_role, granted_by, created_on FROM directory
      WHERE deleted_on IS NULL AND default_role LIKE '%ADMIN%' AND default_role NOT IN ('ACCOUNTADMIN')""",
    "shared_ip": f"""WITH {LG} SELECT 'Shared Credential Risk' AS check_name, client_ip, user_name, user_count FROM
      (SELECT client_ip, user_name, count(*) OVER (PARTITION BY client_ip) AS user_count FROM (SELECT DISTINCT client_ip, user_name FROM lg
        WHERE is_success = 'YES' AND event_timestamp >= DATE '2024-01-31' - 7)) WHERE user_count > 1""",
    "daily_security": f"""WITH {LG}, {QH} SELECT coalesce(l.d, q.d) AS audit_date, total_logins, successful_logins, failed_logins, users_logged_in, unique_ips, total_queries, querying_users, tb_scanned
      FROM (SELECT CAST(event_timestamp AS DATE) AS d, count(*) AS total_logins, count(*) FILTER (is_success = 'YES') AS successful_logins,
        count(*) FILTER (is_success = 'NO') AS failed_logins, count(DISTINCT user_name) AS users_logged_in, count(DISTINCT client_ip) AS unique_ips FROM lg GROUP BY 1) l
      FULL OUTER JOIN (SELECT CAST(start_time AS DATE) AS d, count(*) AS total_queries, count(DISTINCT user_name) AS querying_users,
        round(CAST(sum(bytes_scanned) AS DOUBLE) / 1099511627776.0::DOUBLE, 4) AS tb_scanned FROM qh GROUP BY 1) q ON l.d = q.d""",
}
