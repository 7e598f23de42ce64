"""The metric layer: what each mart can be grouped by, and how its measures add up."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadbook import settings as S
from roadbook.functions import exact
from roadbook.plans import serving


@dataclass(frozen=True)
class Dimension:
    name: str
    type: str = "string"
    allowed: tuple[str, ...] | None = None


@dataclass(frozen=True)
class Measure:
    """``scale`` is the number of decimals the mart stores; sums stay exact with it."""

    name: str
    aggregation: str
    scale: int = 2

    def column(self) -> Column:
        if self.aggregation == "avg":
            return exact.mean(self.name, self.scale)
        if self.scale == 0:
            return F.sum(self.name)
        return exact.total(self.name, self.scale)


@dataclass(frozen=True)
class MetricTable:
    name: str
    dimensions: dict[str, Dimension]
    measures: dict[str, Measure]


def _table(name: str, dimensions: list[Dimension], measures: list[Measure]) -> MetricTable:
    return MetricTable(name, {d.name: d for d in dimensions}, {m.name: m for m in measures})


# The published dimensions, measures and default aggregations.
# vehicles_on_route sums a distinct count, so over several days or routes it
# counts a vehicle more than once.
METRIC_TABLES: dict[str, MetricTable] = {
    t.name: t
    for t in (
        _table("mart_route_efficiency", [
            Dimension("route_id"),
            Dimension("route_name"),
            Dimension("zone"),
            Dimension("district"),
            Dimension("segment_date", "date"),
        ], [
            Measure("avg_speed", "avg"),
            Measure("total_miles", "sum", 4),
            Measure("avg_idle_pct", "avg"),
            Measure("vehicles_on_route", "sum", 0),
            Measure("efficiency_score", "avg"),
        ]),
        _table("mart_fleet_health", [
            Dimension("vehicle_id"),
            Dimension("vehicle_class", allowed=tuple(S.VEHICLE_CLASSES)),
            Dimension("make"),
            Dimension("model"),
            Dimension("status"),
            Dimension("maintenance_urgency", allowed=tuple(S.URGENCY_LEVELS)),
            Dimension("last_service_date", "date"),
        ], [
            Measure("days_since_service", "avg", 0),
            Measure("total_cost_ytd", "sum"),
        ]),
        _table("mart_driver_performance", [
            Dimension("vehicle_id"),
            Dimension("vehicle_class"),
            Dimension("month", "date"),
        ], [
            Measure("avg_speed", "avg"),
            Measure("idle_pct", "avg"),
            Measure("total_miles", "sum"),
            Measure("safety_score", "avg"),
        ]),
    )
}


class UnknownMetric(ValueError):
    """A table, dimension, measure or value that the metric layer does not know."""


def _known(kind: str, name: str, names: Mapping) -> None:
    if name not in names:
        raise UnknownMetric(f"unknown {kind} {name!r}; known: {', '.join(names)}")


def metric_query(marts: Mapping[str, DataFrame], table: str, dimensions: list[str],
                 measures: list[str], where: Mapping[str, list | tuple] | None = None,
                 order: list[Column] | None = None, limit: int | None = None) -> DataFrame:
    """Group a mart by dimensions, each measure by its default aggregation.

    ``where`` maps a dimension to a list of values to keep, or to an inclusive
    ``(low, high)`` pair in which None leaves a side open. Names and enumerated
    values are checked before anything runs.
    """
    _known("table", table, METRIC_TABLES)
    spec = METRIC_TABLES[table]
    for name in [*dimensions, *(where or {})]:
        _known("dimension", name, spec.dimensions)
    for name in measures:
        _known("measure", name, spec.measures)
    df = marts[table]
    for name, values in (where or {}).items():
        if isinstance(values, str):
            raise UnknownMetric(f"the values of {name} must be a list or a (low, high) pair, not {values!r}")
        if isinstance(values, tuple):
            low, high = values
            df = df.where(F.col(name) >= F.lit(low)) if low is not None else df
            df = df.where(F.col(name) <= F.lit(high)) if high is not None else df
            continue
        allowed = spec.dimensions[name].allowed
        for value in values:
            if allowed and value not in allowed:
                raise UnknownMetric(f"{value!r} is not a value of {name}; known: {', '.join(allowed)}")
        df = df.where(F.col(name).isin(list(values)))
    out = df.groupBy(*dimensions).agg(*[spec.measures[m].column().alias(m) for m in measures])
    if order:
        out = out.orderBy(*order)
    return out.limit(limit) if limit is not None else out


def metric_groupings(marts: Mapping[str, DataFrame], table: str, queries: list[tuple[list[str], list[str]]]) -> DataFrame:
    """Several (dimensions, measures) of one mart in one pass over it: ``query``, all dimensions, all measures.

    ``query`` is the place in the list. A dimension that a query does not group by, and a measure that it does
    not ask for, is NULL in its rows; a group of NULLs is a row of its own, told from a total by the grouping.
    """
    _known("table", table, METRIC_TABLES)
    spec = METRIC_TABLES[table]
    for dimensions, measures in queries:
        for name in dimensions:
            _known("dimension", name, spec.dimensions)
        for name in measures:
            _known("measure", name, spec.measures)
    dims = list(dict.fromkeys(d for dimensions, _ in queries for d in dimensions))
    wanted = list(dict.fromkeys(m for _, measures in queries for m in measures))
    sets = list(dict.fromkeys(tuple(d for d in dims if d in dimensions) for dimensions, _ in queries))
    df = marts[table]
    if dims:
        grouped = df.groupingSets([[F.col(d) for d in group] for group in sets], *[F.col(d) for d in dims]).agg(
            F.grouping_id(*dims).alias("_grouping"), *[spec.measures[m].column().alias(m) for m in wanted])
    else:
        grouped = df.agg(F.lit(0).alias("_grouping"), *[spec.measures[m].column().alias(m) for m in wanted])
    # a grouping's bits: one for each dimension that is left out, the first dimension's highest
    bits = {group: sum(1 << (len(dims) - 1 - i) for i, d in enumerate(dims) if d not in group) for group in sets}
    asked = F.array(*[F.struct(F.lit(i).alias("query"), F.lit(bits[tuple(d for d in dims if d in dimensions)]).alias("bits"),
                               *[F.lit(m in measures).alias(f"has_{m}") for m in wanted])
                      for i, (dimensions, measures) in enumerate(queries)])
    told = grouped.withColumn("_asked", F.explode(F.filter(asked, lambda q: q["bits"] == F.col("_grouping"))))
    return told.select(F.col("_asked")["query"].alias("query"), *dims,
                       *[F.when(F.col("_asked")[f"has_{m}"], F.col(m)).alias(m) for m in wanted])


@dataclass(frozen=True)
class VerifiedQuery:
    name: str
    question: str
    build: Callable[[Mapping[str, DataFrame], date], DataFrame]


# The names and questions of the verified queries.
VERIFIED: dict[str, VerifiedQuery] = {
    q.name: q
    for q in (
        VerifiedQuery(
            "top_idle_routes_last_week",
            "Which routes had the highest idle time last week?",
            lambda marts, as_of: serving.top_idle_routes_last_week(
                marts["mart_route_efficiency"], as_of)),
        VerifiedQuery(
            "vehicles_overdue_maintenance",
            "Show me vehicles overdue for maintenance",
            lambda marts, as_of: serving.vehicles_overdue_maintenance(marts["mart_fleet_health"])),
        VerifiedQuery(
            "avg_speed_by_zone",
            "What is the average speed by route zone?",
            lambda marts, as_of: serving.avg_speed_by_zone(marts["mart_route_efficiency"])),
        VerifiedQuery(
            "monthly_fleet_cost",
            "What is the total maintenance cost per vehicle class this year?",
            lambda marts, as_of: serving.monthly_fleet_cost(marts["mart_fleet_health"])),
        VerifiedQuery(
            "lowest_efficiency_routes",
            "Which routes have the lowest efficiency scores this month?",
            lambda marts, as_of: serving.lowest_efficiency_routes(
                marts["mart_route_efficiency"], as_of)),
    )
}


def answer(question: str, marts: Mapping[str, DataFrame], as_of: date) -> DataFrame:
    """The verified query of that name, or of exactly that question."""
    for query in VERIFIED.values():
        if question in (query.name, query.question):
            return query.build(marts, as_of)
    raise UnknownMetric(f"no verified query for {question!r}; known: "
                        + "; ".join(q.question for q in VERIFIED.values()))
