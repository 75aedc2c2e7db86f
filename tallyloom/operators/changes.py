"""Change feeds between snapshots, and the merges that consume them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.ordered import dense_ids


def _pairs(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key with its old and new image; a repeated key on either side raises."""
    rest = [c for c in new.columns if c not in keys]
    image = F.struct(*rest)
    sides = old.select(*keys, image.alias("_o"), F.lit(None).cast(new.select(image).schema[0].dataType).alias("_n")).unionByName(
        new.select(*keys, F.lit(None).cast(old.select(image).schema[0].dataType).alias("_o"), image.alias("_n"))
    )
    # keys are unique per side, so a partial aggregate before the shuffle would only sort for nothing
    grouped = sides.repartition(*keys).groupBy(*keys).agg(
        F.first("_o", ignorenulls=True).alias("_old"), F.first("_n", ignorenulls=True).alias("_new"),
        F.greatest(F.count("_o"), F.count("_n")).alias("_copies"),
    )
    clash = F.raise_error(F.concat(F.lit("duplicate key in snapshot: "), F.to_json(F.struct(*keys)))).cast("boolean")
    return grouped.filter(F.when(F.col("_copies") > 1, clash).otherwise(~F.col("_old").eqNullSafe(F.col("_new"))))


def change_feed(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that differ between two snapshots, as a standard change stream shows them.

    Inserts and deletes give one row; an update gives its DELETE and INSERT
    pair, flagged ``_is_update`` and sharing one ``_row_id``. Comparison is
    null-safe. Both snapshots are shuffled once on the key.
    """
    pairs = _pairs(old, new, keys)
    both = F.col("_old").isNotNull() & F.col("_new").isNotNull()
    before = F.when(F.col("_old").isNotNull(), F.struct(F.lit("DELETE").alias("_action"), F.col("_old").alias("_image")))
    after = F.when(F.col("_new").isNotNull(), F.struct(F.lit("INSERT").alias("_action"), F.col("_new").alias("_image")))
    rows = pairs.select(
        *keys, both.alias("_is_update"), F.to_json(F.struct(*keys)).alias("_row_id"), F.explode(F.array_compact(F.array(before, after))).alias("_c")
    )
    return rows.select(*keys, "_c._image.*", F.col("_c._action").alias("_action"), "_is_update", "_row_id")


def revenue_movements(old: DataFrame, new: DataFrame, as_of: Column) -> DataFrame:
    """Subscription changes as NEW, CHURN, EXPANSION or CONTRACTION with both amounts."""
    was, now = F.coalesce("_old.mrr_amount", F.lit(0)), F.coalesce("_new.mrr_amount", F.lit(0))
    kind = (
        F.when(F.col("_old").isNull(), "NEW").when(F.col("_new").isNull(), "CHURN")
        .when(now > was, "EXPANSION").when(now < was, "CONTRACTION").otherwise("UNKNOWN")
    )
    return _pairs(old, new, ["subscription_id"]).select(
        as_of.alias("movement_date"), F.coalesce("_new.customer_id", "_old.customer_id").alias("customer_id"), "subscription_id",
        F.coalesce("_new.product_name", "_old.product_name").alias("product_name"), kind.alias("movement_type"),
        was.alias("previous_mrr"), now.alias("new_mrr"), (now - was).alias("mrr_change"),
    )


def revenue_movements_as_written(feed: DataFrame, as_of: Column) -> DataFrame:
    """One row per feed row; an update is an EXPANSION when its own amount is positive."""
    update, insert = F.col("_is_update"), F.col("_action") == "INSERT"
    kind = (
        F.when(insert & ~update, "NEW").when(~insert & ~update, "CHURN")
        .when(update, F.when(F.col("mrr_amount") > 0, "EXPANSION").otherwise("CONTRACTION")).otherwise("UNKNOWN")
    )
    return feed.select(
        as_of.alias("movement_date"), "customer_id", "subscription_id", "product_name", kind.alias("movement_type"),
        F.lit(0).alias("previous_mrr"), F.col("mrr_amount").alias("new_mrr"), F.col("mrr_amount").alias("mrr_change"),
    )


def merge_dimension(
    dim: DataFrame, feed: DataFrame, key: str, tracked: Sequence[str], at: Column, surrogate: str,
    mode: str = "versioned", close_deleted: bool = False, order: Sequence[str] = (), changed_only: bool = False, highest: Column | None = None,
) -> DataFrame:
    """Close changed rows of a slowly changing dimension and add their new versions.

    With ``changed_only`` the result is the closed and the added rows alone; ``dim``
    may then be the rows of the fed keys, with ``highest`` the last surrogate given.

    A key may change several times in one feed: the last change by the ``order``
    columns counts, an insert after a delete of the same moment. Without
    ``order`` a key with two new images raises, as nothing says which is the last.

    Only current rows take part in the join; history passes through. With
    ``mode="as_written"`` a changed key is closed and its new version is not
    inserted. Deletes in the feed are ignored unless ``close_deleted``.
    """
    if mode not in ("versioned", "as_written"):
        raise ValueError(mode)
    attributes = [c for c in dim.columns if c not in (key, surrogate, "is_current", "effective_from", "effective_to")]
    changes = feed.filter("_action = 'INSERT' OR NOT _is_update").select(
        F.col(key).alias("_key"), F.when(F.col("_action") == "INSERT", F.struct(*attributes)).alias("_in"), F.struct(*order, F.col("_action") == "INSERT").alias("_at"),
    )
    last = changes.groupBy("_key").agg(F.max_by(F.struct("_in"), "_at").alias("_last"), F.count("_in").alias("_images"))
    clash = F.raise_error(F.concat(F.lit("a key changes twice and no order is given: "), F.col("_key").cast("string"))).cast("boolean")
    if not order:
        last = last.filter(F.when(F.col("_images") > 1, clash).otherwise(True))
    incoming = last.select("_key", F.col("_last._in").alias("_in"), F.col("_last._in").isNull().alias("_gone"))
    if not close_deleted:
        incoming = incoming.filter("NOT _gone")

    history, current = dim.filter("NOT is_current"), dim.filter("is_current")
    joined = current.join(incoming, F.col(key) == F.col("_key"), "full")
    differs = F.lit(False)
    for c in tracked:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"_in.{c}"))
    matched = F.col(key).isNotNull() & F.col("_key").isNotNull()
    closes = matched & (F.col("_gone") | (F.col("_in").isNotNull() & differs))
    adds = F.col("_in").isNotNull() & (F.col(key).isNull() | (matched & differs if mode == "versioned" else F.lit(False)))

    stay = F.col(key).isNotNull() & F.coalesce(closes, F.lit(False)) if changed_only else F.col(key).isNotNull()
    kept = joined.filter(stay).select(
        *[c for c in dim.columns if c not in ("is_current", "effective_to")],
        (~F.coalesce(closes, F.lit(False))).alias("is_current"),
        F.when(F.coalesce(closes, F.lit(False)), at).otherwise(F.col("effective_to")).alias("effective_to"),
    )
    highest = dim.agg(F.coalesce(F.max(surrogate), F.lit(0))).scalar() if highest is None else highest
    added = dense_ids(joined.filter(adds).select(F.col("_key").alias(key), "_in.*"), [F.col(key)], "_id")
    added = added.withColumns({
        surrogate: (highest + F.col("_id")).cast(dim.schema[surrogate].dataType), "is_current": F.lit(True), "effective_from": at, "effective_to": F.lit(None).cast(dim.schema["effective_to"].dataType),
    })
    changed = kept.unionByName(added.select(*dim.columns))
    return changed if changed_only else history.unionByName(changed)


def merge_additive(target: DataFrame, batch: DataFrame, keys: Sequence[str], add: Sequence[str], replace: Sequence[str] = ()) -> DataFrame:
    """MERGE that adds measures to existing rows and inserts new keys.

    A union and one aggregation: a single shuffle, with partial sums before it.
    ``replace`` columns take the batch value where the batch has the key.
    """
    both = target.select(*keys, *add, *replace).withColumn("_fresh", F.lit(False)).unionByName(batch.select(*keys, *add, *replace).withColumn("_fresh", F.lit(True)))
    return both.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in add],
        *[F.coalesce(F.max(F.when(F.col("_fresh"), F.col(c))), F.max(c)).alias(c) for c in replace],
    )
