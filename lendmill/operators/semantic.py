"""Declared metrics by declared dimensions, each at the grain it belongs to."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendmill.fixed_values import DIMENSION_SYNONYMS, TABLE_SYNONYMS


@dataclass(frozen=True)
class MetricDef:
    """A metric as parts that add up, and how the parts make the number.

    Parts are sums or counts over rows, so they can be reduced per join key
    before dimensions of another table are attached.
    """

    table: str
    parts: dict[str, Callable[[], Column]]
    finish: Callable[[dict[str, Column]], Column]


@dataclass(frozen=True)
class Model:
    dimensions: dict[str, str]
    metrics: dict[str, MetricDef]
    # table -> {referenced table: join column}; the reference is many-to-one.
    references: dict[str, dict[str, str]] = field(default_factory=dict)
    synonyms: dict[str, tuple[str, ...]] = field(default_factory=dict)


def _single(table: str, expr: Callable[[], Column]) -> MetricDef:
    return MetricDef(table, {"v": expr}, lambda p: p["v"])


def _mean(table: str, column: str) -> MetricDef:
    return MetricDef(
        table,
        {"s": lambda: F.sum(column), "n": lambda: F.count(column)},
        lambda p: p["s"].cast("double") / F.nullif(p["n"], F.lit(0)),
    )


LOAN_PORTFOLIO = Model(
    dimensions={
        "product_segment": "loans",
        "dpd_bucket": "loans",
        "status": "loans",
        "province": "customers",
        "segment": "customers",
        "city": "customers",
    },
    metrics={
        "total_loans": _single("loans", lambda: F.count("loan_id")),
        "npl_rate": _mean("loans", "is_default"),
        "total_outstanding": _single("loans", lambda: F.sum("outstanding")),
        "total_customers": _single("customers", lambda: F.count("customer_id")),
        "total_savings": _single("customers", lambda: F.sum("total_savings_balance")),
    },
    references={"loans": {"customers": "customer_id"}},
    synonyms={**TABLE_SYNONYMS, **DIMENSION_SYNONYMS},
)


def resolve(model: Model, term: str) -> str:
    """The declared name behind a business word."""
    wanted = term.strip().lower()
    for name in (*model.dimensions, *model.metrics, *model.synonyms):
        if wanted == name or wanted in model.synonyms.get(name, ()):
            return name
    raise KeyError(f"no table, dimension or metric is called {term!r}")


def semantic_query(
    model: Model,
    tables: dict[str, DataFrame],
    metrics: list[str],
    dims: list[str],
    where: dict[str, object] | None = None,
) -> DataFrame:
    """Metrics by dimensions; ``where`` maps a dimension to the value it must have.

    Every table is reduced at its own grain first: joining customers to their
    loans before summing would count a customer's savings once per loan.
    """
    dims = [resolve(model, d) for d in dims]
    metrics = [resolve(model, m) for m in metrics]
    where = {resolve(model, d): v for d, v in (where or {}).items()}
    per_table = []
    for table in dict.fromkeys(model.metrics[m].table for m in metrics):
        mine = [m for m in metrics if model.metrics[m].table == table]
        per_table.append(_at_own_grain(model, tables, table, mine, dims, where))
    if len(per_table) == 1:
        return per_table[0].select(*dims, *metrics)
    # Stack and regroup instead of joining: groups with a missing dimension
    # value match by themselves, and a table without a group leaves a NULL.
    stacked = per_table[0]
    for frame in per_table[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    return stacked.groupBy(*dims).agg(*[F.max(m).alias(m) for m in metrics])


def _at_own_grain(model, tables, table, metrics, dims, where) -> DataFrame:
    needed = list(dict.fromkeys([*dims, *where]))
    own = [d for d in needed if model.dimensions[d] == table]
    borrowed = [d for d in needed if model.dimensions[d] != table]
    links = model.references.get(table, {})
    unreachable = [d for d in borrowed if model.dimensions[d] not in links]
    if unreachable:
        raise ValueError(f"{table} metrics cannot be split by {', '.join(unreachable)}: fan-out")
    parts = {
        f"{m}__{p}": expr for m in metrics for p, expr in model.metrics[m].parts.items()
    }
    rows = tables[table]
    for d in own:
        if d in where:
            rows = rows.filter(F.col(d) == where[d])
    if borrowed:
        # Reduce to one row per referenced key and own dimension, attach the
        # borrowed dimensions, then add up. A customer with very many loans is
        # one row per own dimension by the time rows move.
        keys = list(dict.fromkeys(links[model.dimensions[d]] for d in borrowed))
        rows = rows.groupBy(*keys, *own).agg(*[e().alias(n) for n, e in parts.items()])
        for target in dict.fromkeys(model.dimensions[d] for d in borrowed):
            columns = [d for d in borrowed if model.dimensions[d] == target]
            other = tables[target].select(links[target], *columns)
            kept = [d for d in columns if d in where]
            for d in kept:
                other = other.filter(F.col(d) == where[d])
            rows = rows.join(other, links[target], "inner" if kept else "left")
        final = [F.sum(n).alias(n) for n in parts]
    else:
        final = [e().alias(n) for n, e in parts.items()]
    grouped = rows.groupBy(*dims).agg(*final)
    return grouped.select(
        *dims,
        *[
            model.metrics[m]
            .finish({p: F.col(f"{m}__{p}") for p in model.metrics[m].parts})
            .alias(m)
            for m in metrics
        ],
    )
