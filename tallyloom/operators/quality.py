"""Data-quality and sensitive-data profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tallyloom.functions.numbers import count_when, safe_pct

# Value patterns per category (fixed values; no look-around, so any engine can run them)
VALUE_PATTERNS = {
    "EMAIL": "[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{2,}",
    "PHONE": "[(]?[0-9]{3}[)]?[ -][0-9]{3}-[0-9]{4}",
    "SSN": "[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "NAME": "^[A-Z][a-z]+( [A-Z][.]?)? [A-Z][a-z]+$",
    "ADDRESS": "^[0-9]+ [A-Z][A-Za-z]+( [A-Z][A-Za-z]+)* (Street|St|Avenue|Ave|Road|Rd|Lane|Ln|Drive|Dr|Way|Square)[.]?(,|$)",
}
# Column-name fragments per category (fixed values)
NAME_HINTS = {"EMAIL": ["email"], "PHONE": ["phone"], "NAME": ["name"], "ADDRESS": ["address"], "SSN": ["ssn", "social"]}


def name_category(column: str) -> str:
    return next((cat for cat, parts in NAME_HINTS.items() if any(p in column.lower() for p in parts)), "OTHER")


def sensitive_columns(df: DataFrame) -> DataFrame:
    """Share of values per string column that look like each category, from one pass over the data."""
    columns = [f.name for f in df.schema if isinstance(f.dataType, StringType)]
    counts = [F.count(c).alias(f"n_{i}") for i, c in enumerate(columns)]
    counts += [count_when(F.col(c).rlike(p)).alias(f"h_{i}_{k}") for i, c in enumerate(columns) for k, p in VALUE_PATTERNS.items()]
    rows = [
        F.struct(
            F.lit(c).alias("column_name"), F.lit(name_category(c)).alias("name_category"), F.lit(k).alias("category"),
            F.col(f"n_{i}").alias("non_null"), F.col(f"h_{i}_{k}").alias("hits"), safe_pct(F.col(f"h_{i}_{k}"), F.col(f"n_{i}"), 4).alias("hit_pct"),
        )
        for i, c in enumerate(columns) for k in VALUE_PATTERNS
    ]
    return df.agg(*counts).select(F.inline(F.array(*rows)))


def column_profile(df: DataFrame) -> DataFrame:
    """Null, distinct and duplicate counts of every column in one shuffle.

    Values are unpivoted to (column, value) and counted, so repeated values
    collapse before the shuffle; long strings travel as their MD5.
    """
    def text(f):
        c = F.col(f.name).cast("string")
        return F.when(F.length(c) > 32, F.md5(c)).otherwise(c) if isinstance(f.dataType, StringType) else c

    cells = F.array(*[F.struct(F.lit(f.name).alias("column_name"), text(f).alias("v")) for f in df.schema])
    counted = df.select(F.inline(cells)).groupBy("column_name", "v").agg(F.count("*").alias("n"))
    present = F.col("v").isNotNull()
    return counted.groupBy("column_name").agg(
        F.sum("n").alias("total_rows"), F.coalesce(F.sum(F.when(~present, F.col("n"))), F.lit(0)).alias("null_count"), count_when(present).alias("unique_count"),
        F.coalesce(F.sum(F.when(present, F.col("n") - 1)), F.lit(0)).alias("duplicate_count"),
    )


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).filter("copies > 1")
