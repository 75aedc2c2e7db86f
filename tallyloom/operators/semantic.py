"""A small semantic layer: named tables, joins, dimensions and metrics over DataFrames."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.sources.tables import union_padded


@dataclass
class Named:
    """A dimension, fact or metric: the table it belongs to, its expression, label and other names."""

    table: str
    expr: Column
    label: str = ""
    synonyms: tuple[str, ...] = ()


@dataclass
class SemanticModel:
    tables: dict[str, DataFrame]
    keys: dict[str, str]
    relationships: list[tuple[str, str, str]]  # (child table, foreign key, parent table)
    dimensions: dict[str, Named]
    metrics: dict[str, Named]
    facts: dict[str, Named] = field(default_factory=dict)

    def resolve(self, name: str, among: dict[str, Named]) -> str:
        wanted = name.lower()
        for key, item in among.items():
            if wanted in (key, item.label.lower(), *(s.lower() for s in item.synonyms)):
                return key
        raise KeyError(name)


def widened(model: SemanticModel, table: str, wanted: set[str]) -> DataFrame:
    """A table joined to the ancestors that lead to the wanted tables, over any number of relationships; no row is repeated."""
    frame, reached, ends = model.tables[table], {table}, [table]
    leads = lambda t: t in wanted or any(leads(up) for child, _, up in model.relationships if child == t)
    while ends:
        at = ends.pop(0)
        for child, key, parent in model.relationships:
            if child == at and parent not in reached and leads(parent):
                owner, taken = model.tables[parent], set(frame.columns)
                frame = frame.join(owner.select(key, *[c for c in owner.columns if c not in taken]), key, "left")
                reached.add(parent)
                ends.append(parent)
    if wanted - reached:
        raise ValueError(f"{sorted(wanted - reached)} would repeat rows of {table}")
    return frame


def query_facts(model: SemanticModel, facts: list[str], dimensions: list[str]) -> DataFrame:
    """Facts row by row with dimensions, at the grain of the most detailed table among those named."""
    facts = [model.resolve(f, model.facts) for f in facts]
    dimensions = [model.resolve(d, model.dimensions) for d in dimensions]
    wanted = {model.facts[f].table for f in facts} | {model.dimensions[d].table for d in dimensions}
    for table in wanted:
        try:
            frame = widened(model, table, wanted)
        except ValueError:
            continue
        return frame.select(*[model.dimensions[d].expr.alias(d) for d in dimensions], *[model.facts[f].expr.alias(f) for f in facts])
    raise ValueError(f"no table reaches all of {sorted(wanted)}")


def query_metrics(model: SemanticModel, metrics: list[str], dimensions: list[str]) -> DataFrame:
    """Metrics by dimensions, aggregated per source table and then aligned.

    A metric's table is joined only upwards, to the parents that own the
    requested dimensions, so no row is multiplied. Metrics of different tables
    meet as aggregated rows: a union and one aggregation on the dimensions.
    """
    metrics = [model.resolve(m, model.metrics) for m in metrics]
    dimensions = [model.resolve(d, model.dimensions) for d in dimensions]
    parts = []
    for table in dict.fromkeys(model.metrics[m].table for m in metrics):
        frame = widened(model, table, {model.dimensions[d].table for d in dimensions})
        grouped = frame.withColumns({f"_d_{d}": model.dimensions[d].expr for d in dimensions}).groupBy(*[F.col(f"_d_{d}").alias(d) for d in dimensions])
        parts.append(grouped.agg(*[model.metrics[m].expr.alias(m) for m in metrics if model.metrics[m].table == table]))
    if len(parts) == 1:
        return parts[0].select(*dimensions, *metrics)
    aligned = union_padded(*parts).groupBy(*dimensions).agg(*[F.first(m, ignorenulls=True).alias(m) for m in metrics])
    return aligned.select(*dimensions, *metrics)


def semantic_view(df: DataFrame, columns: dict[str, str], aliases: dict[str, str] | None = None) -> DataFrame:
    """A column list with comments in the schema metadata and business aliases."""
    aliases = aliases or {}
    return df.select(*[F.col(c).alias(aliases.get(c, c), metadata={"comment": text}) for c, text in columns.items()])
