"""A stream run to its end gives the batch result."""

from oracles.incremental import SQL as BATCH

SQL = {"usage_stream": BATCH["usage_recomputed"], "dimension_stream": BATCH["scd_merge"]}
