"""Governed reads: row policy on raw values first, then column masks."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.masks import tag_mask

Mask = Callable[[Column, str], Column]
SEES_ALL_STATUS = {"admin", "compliance", "engineer"}
SEES_LIVE_STATUS = {"analyst", "viewer", "scientist"}
SEES_ALL_OWNERS = {"admin", "compliance", "scientist", "engineer"}
SEES_OWN = {"analyst", "viewer"}


@dataclass
class Policy:
    masks: dict[str, Mask] = field(default_factory=dict)
    rows: Callable[[str], Column] | None = None


def apply_masks(df: DataFrame, masks: dict[str, Mask], role: str) -> DataFrame:
    return df.withColumns({c: mask(F.col(c), role) for c, mask in masks.items()})


def governed(df: DataFrame, policy: Policy, role: str) -> DataFrame:
    """The frame as ``role`` may see it; the row filter still reaches the scan."""
    visible = df.filter(policy.rows(role)) if policy.rows else df
    return apply_masks(visible, policy.masks, role)


def rows_by_status(status: str = "account_status") -> Callable[[str], Column]:
    def predicate(role: str) -> Column:
        if role in SEES_ALL_STATUS:
            return F.lit(True)
        return F.col(status).isin("Active", "Paused", "Trial") if role in SEES_LIVE_STATUS else F.lit(False)

    return predicate


def rows_by_owner(mapping: DataFrame, user: str, owner: str = "csm_owner") -> Callable[[str], Column]:
    """Rows of the owner mapped to ``user``; a NULL mapping sees all, no mapping sees none.

    ``mapping`` is keyed by user, so the lookup is one row, read as a scalar
    subquery; the big table is only filtered.
    """
    mine = mapping.filter(F.col("user") == user)
    names = mine.agg(F.collect_set("csm_name")).scalar()
    unlimited = mine.filter("csm_name IS NULL").agg(F.count("*") > 0).scalar()

    def predicate(role: str) -> Column:
        if role in SEES_ALL_OWNERS:
            return F.lit(True)
        return (unlimited | F.array_contains(names, F.col(owner))) if role in SEES_OWN else F.lit(False)

    return predicate


def tag_columns(df: DataFrame, tags: dict[str, str], key: str = "pii_category") -> DataFrame:
    """Attach a tag to columns, carried in the schema metadata."""
    return df.select(*[F.col(c).alias(c, metadata={key: tags[c]}) if c in tags else F.col(c) for c in df.columns])


def mask_by_tags(df: DataFrame, role: str, key: str = "pii_category") -> DataFrame:
    return df.select(*[tag_mask(F.col(f.name), f.metadata.get(key), role).alias(f.name) for f in df.schema])
