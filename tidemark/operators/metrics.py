"""Rolling metrics per account and grid time.

All metrics come out of one sweep. Each event opens a counter at the first grid
position that sees it and closes it after the last one, so a count at a position
is the running sum of openings minus closings. Per account the sweep holds at most
one row per grid position, whatever the number of events, which keeps a very busy
account as cheap as any other:

* events are first aggregated per (account, first position, last positions), and
  distinct products per (account, product, first position), both with map-side
  combine and keys that spread one account over many tasks;
* only these compact rows are then brought together per account.

Rows leave the sweep in wide form (one row per account and grid time, one column
per metric, NULL where the metric has no row); the tall tables unpivot it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import as_double, sql_text, timestamp_literal, window_start
from tidemark.operators.grid import Grid
from tidemark.spec import RATIO, SUM_OF_METRICS, TOTAL_EVENTS, UNIQUE_PRODUCTS, ChurnSpec

KEYS = ["account_id", "metric_time"]

#: Events of a task that brings the rows of accounts together; its memory goes with them.
EVENTS_A_TASK = 250_000


@dataclass(frozen=True)
class Counter:
    """Something counted over a trailing window: ``what`` is a SQL condition on an event."""

    name: str
    what: str
    days: int


class Counters:
    """The windowed counters a set of metrics needs, and the metrics on top of them.

    Metrics with the same event type and look-back share a counter. Metric values are
    SQL expressions over the counter columns: ``base`` ones BIGINT, ``derived`` ones
    DOUBLE, NULL where the metric has no row.
    """

    def __init__(self, spec: ChurnSpec, base: Iterable[int] = (), derived: Iterable[int] = ()):
        self.spec = spec
        self.base = [i for i in spec.base_ids if i in set(base)]
        self.derived = [i for i in spec.derived_ids if i in set(derived)]
        self.events: dict[str, Counter] = {}
        self.products: dict[str, Counter] = {}
        self.needs_every_event = False
        for i in self.base:
            self._base_counter(i)
        for i in self.derived:
            self.derived_value(i)

    @property
    def names(self) -> list[str]:
        return [*self.events, *self.products]

    @property
    def lookbacks(self) -> list[int]:
        return sorted({c.days for c in (*self.events.values(), *self.products.values())})

    @property
    def event_filter(self) -> str:
        """Events that matter to the event counters; a plain type list where possible."""
        if self.needs_every_event:
            return "true"
        return " or ".join(sorted({c.what for c in self.events.values()}))

    def any(self, test: str) -> str:
        return " or ".join(f"{n} {test}" for n in self.names)

    def _base_counter(self, i: int) -> str:
        d = self.spec.by_id[i]
        namesake = next(x for x in self.spec.definitions if x.event_type == d.event_type)
        name = f"type{namesake.metric_name_id}_{d.lookback_days}"
        self.events[name] = Counter(name, f"event_type = {sql_text(d.event_type)}", d.lookback_days)
        return name

    def base_value(self, i: int) -> str:
        return f"nullif({self._base_counter(i)}, 0L)"

    def derived_value(self, i: int) -> str:
        d = self.spec.by_id[i]
        if d.metric_kind != RATIO:
            return f"cast(nullif({self._count(i)}, 0L) as double)"
        # the denominator is NULL (no row) or positive, never zero
        return f"cast({self._count(d.numerator)} as double) / cast(nullif({self._count(d.denominator)}, 0L) as double)"

    def _count(self, i: int) -> str:
        """What a metric counts, 0 where it has no row; sums of sums are taken apart."""
        d = self.spec.by_id[i]
        days = d.lookback_days
        if d.metric_kind == TOTAL_EVENTS:
            self.needs_every_event = True
            name = f"all_{days}"
            self.events[name] = Counter(name, "true", days)
            return name
        if d.metric_kind == UNIQUE_PRODUCTS:
            name = f"products_{days}"
            self.products[name] = Counter(name, "product_id is not null", days)
            return name
        if d.metric_kind == SUM_OF_METRICS:
            return f"({' + '.join(self._count(c) for c in d.components)})"
        return self._base_counter(i)

    def values(self) -> list[tuple[int, str]]:
        return [(i, self.base_value(i)) for i in self.base] + [
            (i, self.derived_value(i)) for i in self.derived
        ]

    def features(self) -> list[Column]:
        """One DOUBLE column per feature, 0 where the metric has no row."""
        values: dict[int, list[str]] = {}
        for i, v in self.values():
            values.setdefault(i, []).append(f"cast({v} as double)")
        return [
            F.expr(f"coalesce(greatest({', '.join(values[i] * 2)}), 0d)").alias(self.spec.by_id[i].feature)
            for i in self.spec.feature_order
        ]


def all_counters(spec: ChurnSpec) -> Counters:
    return Counters(spec, base=spec.base_ids, derived=spec.derived_ids)


# --- the sweep over the whole grid -----------------------------------------------


def sweep(events: DataFrame, counters: Counters, grid: Grid | None = None) -> DataFrame:
    """``account_id, metric_time`` and one BIGINT per counter, wherever any counter is positive."""
    grid = grid or Grid.of(events, counters.spec)
    seen = events.where(F.col("event_time") < grid.end)
    parts = [_product_changes(seen, c, grid) for c in counters.products.values()]
    if counters.events:
        parts.insert(0, _event_spans(seen, counters, grid))
    spans = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)

    # From here on everything stays within one account: a single exchange of compact rows.
    changes = (
        spans.repartition(*_tasks(events, grid), "account_id")
        .selectExpr("account_id", f"inline({_changes(counters)})")
        .where(f"position <= {grid.last_position} and ({counters.any('<> 0')})")
        .groupBy("account_id", "position")
        .agg(*[F.sum(n).alias(n) for n in counters.names])
    )
    account = "(partition by account_id order by position)"
    so_far = "(partition by account_id order by position rows unbounded preceding)"
    return (
        changes.selectExpr(
            "account_id",
            "position",
            f"coalesce(lead(position) over {account} - 1, {grid.last_position}) as until",
            *[f"sum({n}) over {so_far} as {n}" for n in counters.names],
        )
        .where(counters.any("> 0"))
        .selectExpr("account_id", "explode(sequence(position, until)) as position", *counters.names)
        .select("account_id", grid.time_at(F.col("position")).alias("metric_time"), *counters.names)
    )


def _tasks(events: DataFrame, grid: Grid) -> list[int]:
    """The number of tasks that the accounts of a large log are dealt out to; left to the session for a small one."""
    if grid.n_events <= EVENTS_A_TASK:
        return []
    return [max(events.sparkSession.sparkContext.defaultParallelism, -(-grid.n_events // EVENTS_A_TASK))]


def _event_spans(events: DataFrame, counters: Counters, grid: Grid) -> DataFrame:
    """Event counts per account and span of grid positions."""
    t = F.col("event_time")
    days = sorted({c.days for c in counters.events.values()})
    ends = [f"last_{d}" for d in days]
    return (
        events.where(counters.event_filter)
        .select(
            "account_id",
            "event_type",
            grid.first_seen(t).alias("position"),
            *[grid.last_seen(t, d).alias(e) for d, e in zip(days, ends, strict=True)],
        )
        .groupBy("account_id", "position", *ends)
        .agg(*[F.expr(f"count_if({c.what}) as {c.name}") for c in counters.events.values()])
    )


def _product_changes(events: DataFrame, counter: Counter, grid: Grid) -> DataFrame:
    """Change of the distinct-product count per account and grid position.

    Per product the spans are merged first, so each product is counted once
    however often it was used.
    """
    t = F.col("event_time")
    spans = (
        events.where(counter.what)
        .select(
            "account_id",
            "product_id",
            grid.first_seen(t).alias("start"),
            grid.last_seen(t, counter.days).alias("last"),
        )
        .groupBy("account_id", "product_id", "start")
        .agg(F.max("last").alias("last"))
    )
    product = Window.partitionBy("account_id", "product_id").orderBy("start")
    merged = spans.withColumn("start", F.greatest("start", F.lag("last").over(product) + 1)).where(
        "start <= last"
    )
    return (
        merged.selectExpr(
            "account_id",
            f"inline(array(struct(start as position, 1L as {counter.name}),"
            f" struct(last + 1 as position, -1L as {counter.name})))",
        )
        .where(F.col("position") <= grid.last_position)
        .groupBy("account_id", "position")
        .agg(F.sum(counter.name).alias(counter.name))
    )


def _changes(counters: Counters) -> str:
    """The opening and the closings of one span row, as an array of (position, change per counter)."""

    def row(position: str, sign: str, days: int | None) -> str:
        counts = [
            f"coalesce({sign}{n}, 0L) as {n}" if days is None or counters.events.get(n, _NONE).days == days
            else f"0L as {n}"
            for n in counters.names
        ]
        return f"struct({position} as position, {', '.join(counts)})"

    days = sorted({c.days for c in counters.events.values()})
    return f"array({', '.join([row('position', '', None), *[row(f'last_{d} + 1', '-', d) for d in days]])})"


_NONE = Counter("", "", 0)


# --- one grid time only ----------------------------------------------------------


def counters_at(events: DataFrame, counters: Counters, at: dt.datetime | None) -> DataFrame:
    """The same counters at one grid time, one row per account; no rows if the time is None.

    Only events inside the longest window are read, and every count is a plain
    conditional aggregate.
    """
    t = F.col("event_time")
    upper = timestamp_literal(at or dt.datetime(1970, 1, 1))
    longest = counters.lookbacks[-1]
    inside = [(t >= window_start(upper, d)).alias(f"inside_{d}") for d in counters.lookbacks]
    window = events.where((t < upper) & (t >= window_start(upper, longest)) if at else F.lit(False))

    def within(c: Counter) -> str:
        return c.what if c.days == longest else f"({c.what}) and inside_{c.days}"

    return (
        window.select("account_id", "event_type", "product_id", *inside)
        .groupBy("account_id")
        .agg(
            *[F.expr(f"count_if({within(c)}) as {c.name}") for c in counters.events.values()],
            *[
                F.expr(f"count(distinct case when {within(c)} then product_id end) as {c.name}")
                for c in counters.products.values()
            ],
        )
        .where(counters.any("> 0"))
    )


def last_measured_time(
    events: DataFrame, spec: ChurnSpec, cutoff: dt.date | None = None, grid: Grid | None = None
) -> DataFrame:
    """One row ``metric_time``: the last grid time, not after ``cutoff``, at which any metric has a row.

    Equal to the maximum over the full metric table, but needs only the latest
    span end of the events.
    """
    grid = grid or Grid.of(events, spec)
    t = F.col("event_time")
    limit = grid.last_position if cutoff is None else grid.position_of(cutoff)
    ends = [F.when(c, grid.last_seen(t, d)) for c, d in _reaches(spec)]
    end = F.greatest(*ends) if len(ends) > 1 else ends[0]
    return (
        events.where(t < timestamp_literal(grid.time(limit)))
        .select(grid.first_seen(t).alias("first"), F.least(end, F.lit(limit)).alias("end"))
        .where(F.col("first") <= F.col("end"))
        .agg(F.max("end").alias("position"))
        .select(grid.time_at(F.col("position")).alias("metric_time"))
    )


def find_measured_time(
    events: DataFrame, spec: ChurnSpec, cutoff: dt.date | None = None, grid: Grid | None = None
) -> dt.datetime | None:
    """The time of :func:`last_measured_time`, usually without reading the log.

    One event inside a window of the last candidate time settles it, and looking for
    one stops at the first hit.
    """
    grid = grid or Grid.of(events, spec)
    limit = grid.last_position if cutoff is None else grid.position_of(cutoff)
    if limit < 0:
        return None
    t, last = F.col("event_time"), timestamp_literal(grid.time(limit))
    reaches = _reaches(spec)
    earliest = window_start(last, max(d for _, d in reaches))
    hit = reduce(lambda a, b: a | b, (c & (t >= window_start(last, d)) for c, d in reaches))
    if not events.where((t < last) & (t >= earliest) & hit).isEmpty():
        return grid.time(limit)
    return last_measured_time(events, spec, cutoff, grid).first()["metric_time"]


def _reaches(spec: ChurnSpec) -> list[tuple[Column, int]]:
    """(condition, look-back) of every metric that a row can come from; dominated ones left out."""
    always = max((d.lookback_days for d in spec.definitions if d.metric_kind == TOTAL_EVENTS), default=0)
    out = [(F.lit(True), always)] if always else []
    for d in spec.definitions:
        if d.lookback_days <= always:
            continue
        out.append((F.col("event_type") == d.event_type, d.lookback_days))
        if d.metric_kind == UNIQUE_PRODUCTS:
            out.append((F.col("product_id").isNotNull(), d.lookback_days))
    return out


# --- tall tables -----------------------------------------------------------------


def unpivot(wide: DataFrame, values: list[tuple[int, str]]) -> DataFrame:
    """Wide counters to ``account_id, metric_time, metric_name_id, metric_value``, NULLs dropped."""
    rows = ", ".join(f"struct({i} as metric_name_id, {v} as metric_value)" for i, v in values)
    return wide.selectExpr(*KEYS, f"inline(array({rows}))").where("metric_value is not null")


def event_count_metrics(
    events: DataFrame, spec: ChurnSpec, grid: Grid | None = None, swept: DataFrame | None = None
) -> DataFrame:
    """Events per account, grid time and metric, joined on the event type (BIGINT); read off ``swept``, the sweep of all counters, if given."""
    counters = Counters(spec, base=spec.base_ids)
    return unpivot(sweep(events, counters, grid) if swept is None else swept, counters.values())


def derived_metrics(
    events: DataFrame, spec: ChurnSpec, ids: Iterable[int] | None = None, grid: Grid | None = None, swept: DataFrame | None = None
) -> DataFrame:
    """Totals, distinct counts, sums of metrics and ratios (DOUBLE); all kinds unless ``ids`` is given. ``swept`` as above."""
    counters = Counters(spec, derived=spec.derived_ids if ids is None else ids)
    return unpivot(sweep(events, counters, grid) if swept is None else swept, counters.values())


def _of_kind(events: DataFrame, spec: ChurnSpec, metric_id: int, kind: str) -> DataFrame:
    if spec.by_id[metric_id].metric_kind != kind:
        raise ValueError(f"metric {metric_id} is not of kind {kind}")
    return derived_metrics(events, spec, [metric_id])


def total_events(events: DataFrame, spec: ChurnSpec, metric_id: int = 7) -> DataFrame:
    return _of_kind(events, spec, metric_id, TOTAL_EVENTS)


def unique_products(events: DataFrame, spec: ChurnSpec, metric_id: int = 8) -> DataFrame:
    return _of_kind(events, spec, metric_id, UNIQUE_PRODUCTS)


def sum_of_metrics(events: DataFrame, spec: ChurnSpec, metric_id: int) -> DataFrame:
    return _of_kind(events, spec, metric_id, SUM_OF_METRICS)


def ratio_of_metrics(events: DataFrame, spec: ChurnSpec, metric_id: int) -> DataFrame:
    return _of_kind(events, spec, metric_id, RATIO)


def all_metrics(events: DataFrame, spec: ChurnSpec, grid: Grid | None = None) -> DataFrame:
    """Event-count and derived metrics in one table (values widened to DOUBLE), from one sweep."""
    counters = all_counters(spec)
    return unpivot(sweep(events, counters, grid), [(i, f"cast({v} as double)") for i, v in counters.values()])


def metric_times(events: DataFrame, spec: ChurnSpec, grid: Grid | None = None) -> DataFrame:
    """``metric_name_id, metric_time, n_calc, total, min_value, max_value`` of all metrics, straight from the log.

    The rows of :func:`all_metrics` per metric and time, but aggregated while they are still columns of one wide row: what is
    turned into rows is one line per grid time, not one per account, time and metric.
    """
    counters = all_counters(spec)
    values = [(i, f"cast({v} as double)") for i, v in counters.values()]
    parts = [
        f"named_struct('metric_name_id', {i}, 'n_calc', count({v}), 'total', sum({v}), 'min_value', min({v}), 'max_value', max({v}))"
        for i, v in values
    ]
    per_time = sweep(events, counters, grid).groupBy("metric_time").agg(F.expr(f"array({', '.join(parts)})").alias("parts"))
    rows = per_time.select("metric_time", F.inline("parts")).where("n_calc > 0")
    # a base and a derived metric may share an id
    return rows.groupBy("metric_name_id", "metric_time").agg(
        F.sum("n_calc").alias("n_calc"), F.sum("total").alias("total"), F.min("min_value").alias("min_value"), F.max("max_value").alias("max_value")
    )


def union_metrics(metric: DataFrame, metric_derived: DataFrame) -> DataFrame:
    """The same table from two stored ones."""
    columns = [*KEYS, "metric_name_id", as_double("metric_value").alias("metric_value")]
    return metric.select(*columns).unionByName(metric_derived.select(*columns))
