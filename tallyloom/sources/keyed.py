"""Keyed tables whose batches are written beside each other and merged on read.

A batch holds the new images of the keys it touches and nothing else, dealt into
buckets by a hash of ``bucketed`` columns. A reader takes the newest image of every
key over the base and the batches after it; for a set of keys it opens their
buckets alone. Compaction folds chosen buckets into a new base of these. The commit
log says which folders count, so a batch that was applied is not applied again.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tallyloom.sources.commits import commit, entries, new_folder, next_version


class KeyedTable:
    def __init__(self, spark: SparkSession, root: str, schema: StructType, keys: Sequence[str], bucketed: Sequence[str] | None = None, buckets: int = 16):
        self.spark, self.root, self.schema, self.keys = spark, root, schema, list(keys)
        self.bucketed, self.buckets = list(bucketed or keys), buckets

    def _bucket(self):
        return F.pmod(F.hash(*self.bucketed), F.lit(self.buckets))

    def has(self, batch: int) -> bool:
        """Whether a batch has been committed."""
        return any(e.batch == batch for e in entries(self.spark, self.root))

    def mark(self) -> int | None:
        """The number that the newest batch was committed with."""
        return max((e.mark for e in entries(self.spark, self.root) if e.mark is not None), default=None)

    def _write(self, rows: DataFrame, kind: str, **fields) -> None:
        folder, version = new_folder(), next_version(entries(self.spark, self.root))
        # a bucket's rows meet in few files; a large bucket is split
        rows.select(*self.schema.names, self._bucket().alias("_bucket")).hint("rebalance", F.col("_bucket")).write.partitionBy("_bucket").parquet(f"{self.root}/{folder}")
        written = self._folder(folder).count()
        commit(self.spark, self.root, version, folder, rows=written, kind=kind, **fields)

    def append(self, rows: DataFrame, batch: int, mark: int | None = None) -> None:
        """Commit the new images of a batch; a batch that is there already changes nothing."""
        if not self.has(batch):
            self._write(rows, "batch", batch=batch, mark=mark)

    def _folder(self, folder: str) -> DataFrame:
        whole = StructType([*self.schema.fields, StructField("_bucket", IntegerType())])
        return self.spark.read.schema(whole).parquet(f"{self.root}/{folder}")

    def of_batch(self, batch: int) -> DataFrame:
        """The new images that a committed batch holds, as written."""
        found = next(e for e in entries(self.spark, self.root) if e.batch == batch)
        return self._folder(found.folder).select(*self.schema.names)

    def empty(self, before: int) -> bool:
        """Whether nothing was committed before a batch."""
        return not any(e.batch is None or e.batch < before for e in entries(self.spark, self.root))

    def read(self, of: DataFrame | None = None, before: int | None = None) -> DataFrame:
        """The newest image of every key, or of those whose ``bucketed`` columns occur in ``of``; with ``before``, without that batch and later ones."""
        log = [e for e in entries(self.spark, self.root) if before is None or e.batch is None or e.batch < before]
        if not log:
            return self.spark.createDataFrame([], self.schema)  # nothing is asked of ``of`` then
        base = {b: e.version for e in log if e.kind == "base" for b in e.buckets}
        wanted = None if of is None else [r[0] for r in of.select(self._bucket()).distinct().collect()]  # as many as there are buckets at most
        parts = []
        for e in log:
            rows = self._folder(e.folder)
            if wanted is not None:
                rows = rows.where(F.col("_bucket").isin(wanted))
            folded = [b for b, v in base.items() if v > e.version]
            if folded:
                rows = rows.where(~F.col("_bucket").isin(folded))
            parts.append(rows.withColumn("_version", F.lit(e.version)))
        rows = reduce(DataFrame.unionByName, parts)
        if of is not None:
            asked = of.select(*[F.col(c).alias(f"_of_{c}") for c in self.bucketed]).distinct()
            rows = rows.join(asked, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in self.bucketed]), "left_semi")
        newest = F.max_by(F.struct(*self.schema.names), "_version").alias("_row")
        return rows.groupBy(*[F.col(k).alias(f"_key_{k}") for k in self.keys]).agg(newest).select("_row.*")

    def compact(self, buckets: Sequence[int] | None = None) -> None:
        """Fold the batches of some buckets, or all, into a base of these, between batches; older readers keep what they resolved."""
        chosen = sorted(range(self.buckets) if buckets is None else buckets)
        self._write(self.read().where(self._bucket().isin(chosen)), "base", buckets=chosen)
