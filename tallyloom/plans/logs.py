"""Audit, access and lineage analytics over log tables.

Log tables are large and append-only: every report filters on time first,
projects few columns, and aggregates with map-side combine. Nested access
arrays are exploded after the object filter columns are cut down.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.dates import day, day_diff, days_before
from tallyloom.functions.numbers import bytes_as, count_when, dbl, rounded, safe_div, safe_pct
from tallyloom.sources.lab import ACCESS_AS_OF, EVENTS_AS_OF, Lab
from tallyloom.sources.tables import union_padded

WEEKDAYS = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
PRIVILEGED = ["ACCOUNTADMIN", "SECURITYADMIN", "SYSADMIN"]


def _queries(lab: Lab, days: int = 30) -> DataFrame:
    return lab.query_history().filter((F.col("start_time") >= days_before(EVENTS_AS_OF, days)) & F.col("warehouse_name").like("WH%"))


def _logins(lab: Lab, days: int = 30) -> DataFrame:
    return lab.logins().filter(F.col("event_timestamp") >= days_before(EVENTS_AS_OF, days))


def _access(lab: Lab, days: int = 30) -> DataFrame:
    at = F.col("query_start_time")
    return lab.access_history().filter((at >= days_before(ACCESS_AS_OF, days)) & (at <= day(ACCESS_AS_OF)))


def flatten(df: DataFrame, array: str, name: str = "object_name") -> DataFrame:
    """One row per array element, with the object's name as a column."""
    return df.withColumn("_o", F.explode(array)).withColumn(name, F.col("_o.objectName"))


# -- query history ---------------------------------------------------------


def top_queries(lab: Lab) -> DataFrame:
    slow = _queries(lab).orderBy(F.desc("total_elapsed_time"), "query_id").limit(20)
    return slow.select(
        "query_id", "query_type", "user_name", "role_name", "warehouse_name", "warehouse_size",
        rounded(dbl("total_elapsed_time") / 1000, 2).alias("elapsed_seconds"), dbl("credits_used").alias("cloud_credits"), "rows_produced",
        bytes_as("bytes_scanned", 3).alias("gb_scanned"), F.left("query_text", F.lit(200)).alias("query_preview"),
    )


def volume_by_user(lab: Lab) -> DataFrame:
    status = F.col("execution_status")
    busy = _queries(lab).groupBy("user_name", "role_name").agg(
        F.count("*").alias("query_count"), count_when(status == "SUCCESS").alias("successful_queries"), count_when(status == "FAIL").alias("failed_queries"),
        rounded(safe_div(F.sum("total_elapsed_time"), F.count("*")) / 1000, 2).alias("avg_elapsed_seconds"), bytes_as(F.sum("bytes_scanned"), 4, 4).alias("total_tb_scanned"),
    )
    return busy.orderBy(F.desc("query_count"), "user_name", "role_name").limit(20)


def hour_weekday(lab: Lab) -> DataFrame:
    """Heat table; sorted by hour and calendar order of the weekday names."""
    cells = _queries(lab).groupBy(F.hour("start_time").alias("hour_of_day"), F.dayname(F.to_date("start_time")).alias("day_of_week")).agg(
        F.count("*").alias("query_count"), rounded(safe_div(F.sum("total_elapsed_time"), F.count("*")) / 1000, 4).alias("avg_seconds")
    )
    return cells.orderBy("hour_of_day", F.array_position(F.array(*map(F.lit, WEEKDAYS)), F.col("day_of_week")))


def off_hours(lab: Lab) -> DataFrame:
    hour = F.hour("start_time")
    return _queries(lab).filter((hour < 6) | (hour > 22)).groupBy(F.to_date("start_time").alias("access_date"), "user_name").agg(
        F.count("*").alias("query_count")
    ).withColumn("check_name", F.lit("Off-Hours Access"))


def query_text_search(lab: Lab) -> DataFrame:
    """The statements of the last week that match a case-insensitive pattern."""
    text = F.col("query_text")
    week = lab.query_history().filter(F.col("start_time") >= days_before(EVENTS_AS_OF, 7))
    hits = week.filter(text.ilike("%FROM T WHERE%") & ~text.ilike("%INFORMATION_SCHEMA%"))
    return hits.select("query_id", "query_type", "warehouse_size", "start_time", rounded(dbl("total_elapsed_time") / 1000, 2).alias("seconds"))


# -- access history ----------------------------------------------------------


def recent_access(lab: Lab) -> DataFrame:
    """The accesses of the last week that touched anything, with the numbers of objects."""
    some = _access(lab, 7).filter((F.size("direct_objects_accessed") > 0) | (F.size("objects_modified") > 0))
    return some.select("query_id", "query_start_time", "user_name", F.size("direct_objects_accessed").alias("objects_read"), F.size("objects_modified").alias("objects_written"))


def object_access(lab: Lab) -> DataFrame:
    named = flatten(_access(lab).select("query_start_time", "user_name", "direct_objects_accessed"), "direct_objects_accessed").filter(F.col("object_name").like("%USERS%"))
    return named.groupBy(F.to_date("query_start_time").alias("access_date"), "user_name", F.col("object_name").alias("object_accessed")).agg(
        F.count("*").alias("access_count")
    ).withColumn("audit_note", F.lit("Review for compliance"))


def object_modified(lab: Lab) -> DataFrame:
    rows = flatten(_access(lab).select("query_id", "query_start_time", "user_name", "objects_modified"), "objects_modified", "table_modified").filter(F.col("table_modified").like("PROD%"))
    return rows.select("query_id", "query_start_time", "user_name", "table_modified", F.col("_o.columns").alias("columns_modified"))


def column_access(lab: Lab) -> DataFrame:
    """Most used columns: objects and their columns are flattened in turn."""
    objects = flatten(_access(lab).select("base_objects_accessed"), "base_objects_accessed", "table_name").filter(F.col("table_name").like("PROD.RAW.%"))
    columns = objects.select("table_name", F.explode("_o.columns").alias("_c")).select("table_name", F.col("_c.columnName").alias("column_name"))
    return columns.groupBy("table_name", "column_name").agg(F.count("*").alias("access_count")).orderBy(F.desc("access_count"), "table_name", "column_name").limit(30)


def column_access_rows(lab: Lab) -> DataFrame:
    """The newest column uses of the last day."""
    objects = flatten(_access(lab, 1).select("query_start_time", "user_name", "base_objects_accessed"), "base_objects_accessed", "table_name")
    columns = objects.select("query_start_time", "user_name", "table_name", F.explode("_o.columns.columnName").alias("column_name"))
    return columns.orderBy(F.desc("query_start_time"), "user_name", "table_name", "column_name").limit(100)


def table_reads(lab: Lab) -> DataFrame:
    reads = flatten(_access(lab).select("query_start_time", "user_name", "direct_objects_accessed"), "direct_objects_accessed", "source_table").filter(F.col("source_table").like("PROD.RAW.%"))
    return reads.groupBy(F.to_date("query_start_time").alias("access_date"), "source_table").agg(
        F.count("*").alias("read_count"), F.count_distinct("user_name").alias("unique_users")
    )


def _flows(lab: Lab) -> DataFrame:
    """Every (source, target) pair of one access: two arrays exploded side by side."""
    sources = flatten(_access(lab).select("query_start_time", "base_objects_accessed", "objects_modified"), "base_objects_accessed", "source_table")
    return flatten(sources.select("query_start_time", "source_table", "objects_modified"), "objects_modified", "target_table").select("query_start_time", "source_table", "target_table")


def flow_counts(lab: Lab) -> DataFrame:
    return _flows(lab).filter(F.col("source_table").like("PROD.RAW.%")).groupBy("source_table", "target_table").agg(
        F.count("*").alias("write_count"), F.max("query_start_time").alias("last_write")
    )


def flow_edges(lab: Lab) -> DataFrame:
    return _flows(lab).filter("source_table <> target_table").select(
        F.col("source_table").alias("source_node"), F.col("target_table").alias("target_node"), F.lit("data_flow").alias("edge_type")
    ).distinct()


def lineage_roles(lab: Lab) -> DataFrame:
    """Reads and writes per table; only read is SOURCE, only written TARGET, both INTERMEDIATE."""
    reads = flatten(_access(lab).select("query_start_time", "user_name", "direct_objects_accessed"), "direct_objects_accessed", "table_name").groupBy("table_name").agg(
        F.count("*").alias("read_count"), F.count_distinct("user_name").alias("unique_users"), F.max("query_start_time").alias("last_read")
    )
    writes = flatten(_access(lab).select("query_start_time", "objects_modified"), "objects_modified", "table_name").groupBy("table_name").agg(
        F.count("*").alias("write_count"), F.max("query_start_time").alias("last_write")
    )
    role = F.when(F.col("write_count").isNull(), "SOURCE").when(F.col("read_count").isNull(), "TARGET").otherwise("INTERMEDIATE")
    return reads.join(writes, "table_name", "full").select(
        "table_name", F.coalesce("read_count", F.lit(0)).alias("reads_30d"), F.coalesce("unique_users", F.lit(0)).alias("unique_readers"),
        F.coalesce("write_count", F.lit(0)).alias("writes_30d"), "last_read", "last_write", role.alias("table_role"),
    )


def flow_nodes(lab: Lab) -> DataFrame:
    part = lambda n: F.split_part("table_name", F.lit("."), F.lit(n))
    return lineage_roles(lab).filter("table_name IS NOT NULL").select(
        F.col("table_name").alias("node_id"), part(1).alias("database_name"), part(2).alias("schema_name"), part(-1).alias("object_name"), F.col("table_role").alias("node_type")
    ).distinct()


def dependencies(lab: Lab) -> DataFrame:
    return lab.dependencies().filter((F.col("referencing_database") == "PROD") | (F.col("referenced_database") == "PROD")).select(
        F.col("referencing_object_name").alias("view_name"), F.col("referencing_object_domain").alias("view_type"),
        F.col("referenced_object_name").alias("depends_on_table"), F.col("referenced_object_domain").alias("depends_on_type"),
    )


def _dependents(lab: Lab, table: str) -> DataFrame:
    hit = (F.col("referenced_database") == "PROD") & (F.col("referenced_schema") == "RAW") & (F.col("referenced_object_name") == table)
    full = F.concat_ws(".", "referencing_database", "referencing_schema", "referencing_object_name")
    return lab.dependencies().filter(hit).select(full.alias("dependent_object"), F.col("referencing_object_domain").alias("object_type"))


def dependents(lab: Lab) -> DataFrame:
    return _dependents(lab, "PART_7")


def impact(lab: Lab) -> DataFrame:
    """What depends on one table: its views, and the users who query it."""
    views = _dependents(lab, "PART_7").select(
        F.lit("VIEW").alias("object_type"), F.col("dependent_object").alias("object_name"), F.lit("Direct reference in view definition").alias("impact")
    )
    used = flatten(_access(lab).select("user_name", "direct_objects_accessed"), "direct_objects_accessed").filter("object_name = 'PROD.RAW.PART_7'")
    users = used.groupBy("user_name").agg(F.count("*").alias("n")).select(
        F.lit("QUERY").alias("object_type"), F.concat("user_name", F.lit(" queries")).alias("object_name"), F.concat(F.col("n").cast("string"), F.lit(" queries in period")).alias("impact")
    )
    return union_padded(views, users)


# -- logins and users ------------------------------------------------------------


def logins(lab: Lab) -> DataFrame:
    return _logins(lab, 7).orderBy(F.desc("event_timestamp"), "event_id").limit(100)


def failed_logins(lab: Lab) -> DataFrame:
    failed = _logins(lab).filter("is_success = 'NO'").groupBy(F.to_date("event_timestamp").alias("login_date"), "user_name", "client_ip", "error_code", "error_message").agg(F.count("*").alias("failed_attempts"))
    return failed.orderBy(F.desc("failed_attempts"), "login_date", "user_name", "client_ip", "error_code").limit(20)


def mfa_by_user(lab: Lab) -> DataFrame:
    bare = count_when(F.col("second_authentication_factor").isNull())
    return _logins(lab).filter("is_success = 'YES'").groupBy("user_name").agg(
        F.max("event_timestamp").alias("last_login"), bare.alias("logins_without_mfa"), F.count("*").alias("total_logins"), safe_pct(bare, F.count("*")).alias("pct_without_mfa")
    ).filter("logins_without_mfa > 0")


def mfa(lab: Lab) -> DataFrame:
    factor = F.col("second_authentication_factor")
    return _logins(lab).filter("is_success = 'YES'").agg(
        count_when(factor.isNotNull()).alias("with_mfa"), count_when(factor.isNull()).alias("without_mfa"), safe_pct(count_when(factor.isNotNull()), F.count("*")).alias("mfa_pct")
    ).withColumn("check_name", F.lit("MFA Compliance"))


def directory(lab: Lab) -> DataFrame:
    quiet = day_diff(F.col("last_success_login"), day(EVENTS_AS_OF))
    return lab.directory().filter("deleted_on IS NULL").select("user_name", "email", "default_role", "created_on", "last_success_login", quiet.alias("days_since_login"))


def inactivity(lab: Lab) -> DataFrame:
    return directory(lab).filter(F.col("last_success_login") < days_before(EVENTS_AS_OF, 90)).drop("created_on").withColumnRenamed("days_since_login", "days_inactive")


def role_review(lab: Lab) -> DataFrame:
    grants = lab.directory().filter("deleted_on IS NULL").filter(F.col("default_role").isin(PRIVILEGED))
    return grants.select(F.lit("High Privilege Users").alias("check_name"), F.col("user_name").alias("grantee_name"), F.col("default_role").alias("role"), "granted_by", "created_on")


def role_membership(lab: Lab) -> DataFrame:
    grants = lab.directory().filter(F.col("deleted_on").isNull() & F.col("default_role").like("%ADMIN%") & ~F.col("default_role").isin("ACCOUNTADMIN"))
    return grants.select(F.col("user_name").alias("user_or_role"), F.col("default_role").alias("granted_role"), "granted_by", "created_on")


def shared_ip(lab: Lab) -> DataFrame:
    """A row for every user of an address that several users share."""
    pairs = _logins(lab, 7).filter("is_success = 'YES'").select("client_ip", "user_name").distinct()
    shared = pairs.groupBy("client_ip").agg(F.count("*").alias("user_count")).filter("user_count > 1")
    return pairs.join(shared, "client_ip").withColumn("check_name", F.lit("Shared Credential Risk"))


def daily_security(lab: Lab) -> DataFrame:
    success = F.col("is_success")
    logged = _logins(lab).groupBy(F.to_date("event_timestamp").alias("audit_date")).agg(
        F.count("*").alias("total_logins"), count_when(success == "YES").alias("successful_logins"), count_when(success == "NO").alias("failed_logins"),
        F.count_distinct("user_name").alias("users_logged_in"), F.count_distinct("client_ip").alias("unique_ips"),
    )
    queried = _queries(lab).groupBy(F.to_date("start_time").alias("audit_date")).agg(
        F.count("*").alias("total_queries"), F.count_distinct("user_name").alias("querying_users"), bytes_as(F.sum("bytes_scanned"), 4, 4).alias("tb_scanned")
    )
    return logged.join(queried, "audit_date", "full")


QUERIES = {f.__name__: f for f in [
    top_queries, volume_by_user, hour_weekday, off_hours, query_text_search, recent_access, object_access, object_modified, column_access, column_access_rows,
    table_reads, flow_counts, flow_edges, lineage_roles, flow_nodes, dependencies, dependents, impact, logins, failed_logins, mfa_by_user, mfa, directory,
    inactivity, role_review, role_membership, shared_ip, daily_security,
]}
