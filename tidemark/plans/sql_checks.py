"""The same results as plain SQL, written the long way round.

These texts are deliberately naive (range joins, global windows, sorting everything):
they state what each query must return, independent of how the operators get there.
"""

from __future__ import annotations

from collections.abc import Callable
from math import prod

from tidemark.plans.catalog import LOGS, ON_EVENTS, QUERY_GRID
from tidemark.sources.events import ACTIVITY_TYPES, PRIORITY_TYPES
from tidemark.spec import ChurnSpec


def _relabel(column: str, names: dict[str, str]) -> str:
    return f"case {column} " + " ".join(f"when '{k}' then '{v}'" for k, v in names.items()) + f" else {column} end"


USER_ACTIONS = {
    "e": f"""select cast(user_id as varchar) as account_id, ts as event_time,
        {_relabel('event_type', ACTIVITY_TYPES)} as event_type,
        nullif(cast(json_extract_string(props, '$.k') as integer), 0) as product_id, props as additional_data
        from events""",
    "o": f"""select cast(o.o_custkey as varchar) as account_id, o.o_orderdate as event_time,
        {_relabel('o.o_orderpriority', PRIORITY_TYPES)} as event_type,
        cast(l.l_partkey as integer) as product_id, l.l_returnflag as additional_data
        from orders o join lineitem l on o.o_orderkey = l.l_orderkey""",
}


class Sql:
    """Named building blocks for one log; a text pulls in only the blocks it needs."""

    def __init__(self, log: str):
        self.spec: ChurnSpec = LOGS[log][1]
        self.cutoff = self.spec.cutoff.isoformat()
        self.blocks: dict[str, tuple[str, list[str]]] = {
            "ua": (USER_ACTIONS[log], []),
            "defs": (self._defs(), []),
            "grid": (
                f"""select unnest(generate_series(cast(cast(min(event_time) as date) as timestamp),
                cast(cast(max(event_time) as date) as timestamp), interval {self.spec.step_days} day)) as metric_time
                from ua""",
                ["ua"],
            ),
            "counted": (
                """select u.account_id, g.metric_time, d.metric_name_id, count(*) as metric_value
                from ua u join defs d on d.event_type = u.event_type
                join grid g on u.event_time < g.metric_time
                  and u.event_time >= g.metric_time - to_days(d.lookback_days)
                group by all""",
                ["ua", "defs", "grid"],
            ),
            "quarter": (
                """select u.account_id, g.metric_time, count(*) as n_events, count(distinct u.product_id) as n_products
                from ua u join grid g on u.event_time < g.metric_time
                  and u.event_time >= g.metric_time - interval 90 day
                group by all""",
                ["ua", "grid"],
            ),
            "derived": (self._derived(), ["counted", "quarter"]),
            "every": (
                """select account_id, metric_time, metric_name_id, cast(metric_value as double) as metric_value
                from counted union all select * from derived""",
                ["counted", "derived"],
            ),
            "obs": (self._obs(), ["ua"]),
            "training": (self._training(), ["every", "obs"]),
            "current_": (self._current(), ["every"]),
            "labelled": ("select * replace (cast(is_churn as integer) as is_churn) from training", ["training"]),
            "scored": (
                f"select is_churn, {self.score} as p from labelled",
                ["labelled"],
            ),
            "scored_current": (
                f"select account_id, metric_time, {self.score} as churn_probability from current_",
                ["current_"],
            ),
            "cells": (
                """select count(*) filter (where is_churn = 0 and p < 0.5) as tn,
                count(*) filter (where is_churn = 0 and p >= 0.5) as fp,
                count(*) filter (where is_churn = 1 and p < 0.5) as fn,
                count(*) filter (where is_churn = 1 and p >= 0.5) as tp from scored""",
                ["scored"],
            ),
            "tall": (self._tall(), ["training"]),
            "hashed": (
                """select account_id, is_churn, count(*) over (partition by is_churn) as n,
                row_number() over (partition by is_churn
                  order by md5('42|' || account_id || '|' || cast(observation_date as varchar))) as place
                from labelled""",
                ["labelled"],
            ),
            "sizes": (
                """select is_churn, n - (share + case when rank <= n_train - sum(share) over () then 1 else 0 end) as size
                from (select *, row_number() over (order by remainder desc, is_churn) as rank
                  from (select is_churn, n, n_train, (n * n_train) // total as share, (n * n_train) % total as remainder
                    from (select is_churn, n, total, total - cast(ceil(0.2::double * total) as bigint) as n_train
                      from (select is_churn, count(*) as n, cast(sum(count(*)) over () as bigint) as total
                        from labelled group by is_churn))))""",
                ["labelled"],
            ),
            "split": (
                """select h.account_id, h.is_churn, case when h.place <= s.size then 'valid' else 'train' end as split
                from hashed h join sizes s on h.is_churn = s.is_churn""",
                ["hashed", "sizes"],
            ),
        }

    score = (
        "1.0::double / (1.0::double + 0.3::double * n_total_events_last_90d"
        " + 0.5::double * n_readingownedbook_last_28d)"
    )

    def query(self, body: str, *needs: str) -> str:
        order: list[str] = []

        def add(name: str) -> None:
            for n in self.blocks[name][1]:
                add(n)
            if name not in order:
                order.append(name)

        for n in needs:
            add(n)
        ctes = ",\n".join(f"{n} as materialized ({self.blocks[n][0]})" for n in order)
        return f"with {ctes}\n{body}" if order else body

    def _defs(self) -> str:
        rows = ", ".join(
            f"({d.metric_name_id}, '{d.metric_name}', '{d.event_type}', {d.lookback_days})"
            for d in self.spec.definitions
        )
        return f"select * from (values {rows}) v(metric_name_id, metric_name, event_type, lookback_days)"

    def _derived(self) -> str:
        def relabel(i: int, source: int) -> str:
            return f"""select account_id, metric_time, {i}, cast(metric_value as double)
                from counted where metric_name_id = {source}"""

        def ratio(i: int, numerator: int, denominator: str) -> str:
            return f"""select q.account_id, q.metric_time, {i},
                cast(coalesce(c.metric_value, 0) as double) / q.{denominator}
                from quarter q left join counted c on c.account_id = q.account_id
                  and c.metric_time = q.metric_time and c.metric_name_id = {numerator}
                where q.{denominator} > 0"""

        return "\nunion all ".join(
            [
                """select account_id, metric_time, 7 as metric_name_id, cast(n_events as double) as metric_value
                from quarter""",
                "select account_id, metric_time, 8, cast(n_products as double) from quarter where n_products > 0",
                relabel(9, 3),
                relabel(10, 4),
                ratio(11, 1, "n_events"),
                ratio(12, 2, "n_products"),
            ]
        )

    def _obs(self) -> str:
        types = ", ".join(f"'{t}'" for t in self.spec.retention_event_types)
        return f"""select distinct account_id, date '{self.cutoff}' as observation_date,
            account_id not in (select account_id from ua
              where event_type in ({types}) and event_time >= timestamp '{self.cutoff} 00:00:00') as is_churn
            from ua where event_type in ({types}) and event_time < timestamp '{self.cutoff} 00:00:00'"""

    def _features(self) -> str:
        return ", ".join(
            f"coalesce(max(m.metric_value) filter (where m.metric_name_id = {i}), 0) as {self.spec.by_id[i].feature}"
            for i in self.spec.feature_order
        )

    def _training(self) -> str:
        return f"""select o.account_id, o.observation_date, o.is_churn, {self._features()}
            from obs o left join (select * from every where metric_time = (select max(metric_time) from every
              where metric_time <= timestamp '{self.cutoff} 00:00:00')) m on m.account_id = o.account_id
            group by o.account_id, o.observation_date, o.is_churn"""

    def _current(self) -> str:
        return f"""select m.account_id, m.metric_time, {self._features()} from every m
            where m.metric_time = (select max(metric_time) from every) group by m.account_id, m.metric_time"""

    def _tall(self) -> str:
        columns = ["is_churn", *self.spec.features]
        return " union all ".join(
            f"select '{c}' as name, is_churn as label, cast({'is_churn::integer' if c == 'is_churn' else c} as double)"
            " as value from training"
            for c in columns
        )


def _metric(ids: str, s: Sql, block: str = "derived") -> str:
    return s.query(f"select * from {block} where metric_name_id in ({ids})", block)


def _training_text(s: Sql) -> str:
    return s.query("select * replace (cast(observation_date as varchar) as observation_date) from training", "training")


def _per_month(s: Sql) -> str:
    return s.query(
        """select event_type, a.n_account, count(*) as n_event, round(count(*)::double / a.n_account, 6) as events_per_account,
        round(a.days / 28.0::double, 6) as n_months,
        round((count(*)::double / a.n_account) / nullif(a.days / 28.0::double, 0), 6) as events_per_account_per_month
        from ua, (select count(distinct account_id) as n_account,
          date_diff('day', cast(min(event_time) as date), cast(max(event_time) as date)) as days from ua) a
        group by event_type, a.n_account, a.days""",
        "ua",
    )


def _coverage(s: Sql) -> str:
    return s.query(
        """select metric_name, a.n_account, count(distinct account_id) as count_with_metric,
        round(count(distinct account_id)::double / a.n_account, 6) as pcnt_with_metric,
        round(avg(metric_value), 6) as avg_value, min(metric_value) as min_value, max(metric_value) as max_value,
        min(metric_time) as earliest_metric, max(metric_time) as latest_metric
        from counted join defs using (metric_name_id), (select count(distinct account_id) as n_account from ua) a
        group by metric_name, a.n_account""",
        "counted",
    )


def _stats(s: Sql) -> str:
    return s.query(
        """select metric_name, count(distinct metric_time) as n_metric_dates, min(metric_time) as earliest_metric,
        max(metric_time) as latest_metric, min(metric_value) as min_metric_value,
        round(avg(metric_value), 6) as avg_metric_value, max(metric_value) as max_metric_value
        from every join defs using (metric_name_id) group by metric_name""",
        "every",
    )


def _series(s: Sql) -> str:
    return s.query(
        """select metric_name, metric_time, round(avg(metric_value), 6) as avg_value, min(metric_value) as min_value,
        max(metric_value) as max_value, count(*) as n_calc
        from every join defs using (metric_name_id) group by metric_name, metric_time""",
        "every",
    )


def _daily(s: Sql) -> str:
    types = ", ".join(f"('{t}')" for t in s.spec.event_types)
    return s.query(
        f"""select t.event_type, cast(cast(c.day as date) as varchar) as event_date, count(u.account_id) as n_event
        from (values {types}) t(event_type)
        cross join (select unnest(generate_series(cast(cast(min(event_time) as date) as timestamp),
          cast(cast(max(event_time) as date) as timestamp), interval 1 day)) as day from ua) c
        left join ua u on u.event_type = t.event_type and cast(u.event_time as date) = cast(c.day as date)
        group by 1, 2""",
        "ua",
    )


def _summary(s: Sql) -> str:
    return s.query(
        """select name as column_name, count(value) as count, round(avg((value <> 0)::integer), 6) as nonzero,
        round(avg(value), 6) as mean, round(stddev_samp(value), 6) as std,
        round(case when stddev_samp(value) = 0 then 0 else skewness(value) end, 6) as skew, min(value) as min,
        round(quantile_cont(value, 0.01), 6) as "1pct", round(quantile_cont(value, 0.25), 6) as "25pct",
        round(quantile_cont(value, 0.5), 6) as "50pct", round(quantile_cont(value, 0.75), 6) as "75pct",
        round(quantile_cont(value, 0.99), 6) as "99pct", max(value) as max
        from tall group by name""",
        "tall",
    )


def _cohorts(s: Sql, where: str = "true") -> str:
    return s.query(
        f"""select e.name as metric, cast(e.place - 1 as integer) as cohort, count(t.value) as n_accounts,
        round(avg(t.value), 6) as cohort_mean, round(avg(t.label::integer), 6) as churn_rate
        from (select name, edge as low, lead(edge) over (partition by name order by edge) as high,
            row_number() over (partition by name order by edge) as place
          from (select distinct name, round(unnest(quantile_cont(value,
              [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1])), 12) as edge
            from tall where {where} group by name)) e
        left join (select * from tall where {where}) t on t.name = e.name and round(t.value, 12) <= e.high
          and (round(t.value, 12) > e.low or (e.place = 1 and round(t.value, 12) = e.low))
        where e.high is not null and e.name <> 'is_churn' group by 1, 2""",
        "tall",
    )


def _coerced(s: Sql) -> str:
    cells = ", ".join(
        f"""case when account_id::bigint % 7 in (0, 1, 2, 4) then 0::double else {c} end as {c}"""
        for c in s.spec.features
    )
    return s.query(f"select account_id, metric_time, {cells} from current_", "current_")


def _folds(s: Sql) -> str:
    return s.query(
        """select account_id, is_churn, cast((n // 3 < place)::integer + (2 * n // 3 < place)::integer as integer) as fold
        from hashed""",
        "hashed",
    )


def _metadata(s: Sql) -> str:
    return s.query(
        f"""select count(*) filter (where split = 'train') as n_train_rows,
        count(*) filter (where split = 'valid') as n_valid_rows,
        (select count(*) from current_) as n_current_rows, {len(s.spec.features)} as n_features,
        'is_churn' as target_column, '{','.join(s.spec.features)}' as feature_columns from split""",
        "split",
        "current_",
    )


AUC = """(select sum(case when a.p > b.p then 1.0::double when a.p = b.p then 0.5::double else 0 end)
    / count(*) from scored a, scored b where a.is_churn = 1 and b.is_churn = 0)"""


def _binary(s: Sql) -> str:
    return s.query(
        f"""select round({AUC}, 6) as roc_auc, round((tp + tn)::double / (tp + tn + fp + fn), 6) as accuracy,
        round(coalesce(tp::double / nullif(tp + fp, 0), 0), 6) as precision,
        round(coalesce(tp::double / nullif(tp + fn, 0), 0), 6) as recall from cells""",
        "cells",
    )


def _report(s: Sql) -> str:
    def ratio(a: str, b: str) -> str:
        return f"coalesce(({a})::double / nullif({b}, 0), 0)"

    s0 = [ratio("tn", "tn + fn"), ratio("tn", "tn + fp"), ratio("2 * tn", "2 * tn + fn + fp"), "(tn + fp)"]
    s1 = [ratio("tp", "tp + fp"), ratio("tp", "tp + fn"), ratio("2 * tp", "2 * tp + fn + fp"), "(tp + fn)"]
    acc = ratio("tn + tp", "tn + fp + fn + tp")
    rows = [
        ("0", s0),
        ("1", s1),
        ("accuracy", [acc] * 3 + ["tn + fp + fn + tp"]),
        ("macro avg", [f"({a} + {b}) / 2" for a, b in zip(s0[:3], s1[:3], strict=True)] + ["tn + fp + fn + tp"]),
        (
            "weighted avg",
            [f"({a} * {s0[3]} + {b} * {s1[3]}) / (tn + fp + fn + tp)" for a, b in zip(s0[:3], s1[:3], strict=True)]
            + ["tn + fp + fn + tp"],
        ),
    ]
    return s.query(
        " union all ".join(
            f"""select '{name}' as class, round({p}, 6) as precision, round({r}, 6) as recall,
            round({f}, 6) as f1_score, {n} as support from cells"""
            for name, (p, r, f, n) in rows
        ),
        "cells",
    )


def _curve(s: Sql) -> str:
    return s.query(
        """select round(t.p, 6) as threshold,
        round((select count(*) from scored where is_churn = 0 and p >= t.p)::double
          / (select count(*) from scored where is_churn = 0), 6) as fpr,
        round((select count(*) from scored where is_churn = 1 and p >= t.p)::double
          / (select count(*) from scored where is_churn = 1), 6) as tpr
        from (select distinct p from scored) t
        union all select 'inf'::double, 0.0, 0.0""",
        "scored",
    )


def _predicted(s: Sql, tail: str = "") -> str:
    return s.query(
        f"""select account_id, metric_time, round(churn_probability, 6) as churn_probability,
        (churn_probability >= 0.5)::integer as predicted_is_churn from scored_current t {tail}""",
        "scored_current",
    )


def _histogram(s: Sql) -> str:
    return s.query(
        """select cast(i as integer) as bin, round(low + i * width, 6) as bin_start,
        round(case when i = 29 then high else low + (i + 1) * width end, 6) as bin_end,
        (select count(*) from scored_current c where c.churn_probability >= low + i * width
          and (i = 29 or c.churn_probability < low + (i + 1) * width)) as n_rows
        from (select range as i from range(30)), (select min(churn_probability) as low, max(churn_probability) as high,
          (max(churn_probability) - min(churn_probability)) / 30 as width from scored_current)""",
        "scored_current",
    )


def _score_summary(s: Sql) -> str:
    return s.query(
        """select count(*) as n_customers_scored, round(avg(churn_probability), 6) as mean_churn_probability,
        round(median(churn_probability), 6) as median_churn_probability,
        round(min(churn_probability), 6) as min_churn_probability,
        round(max(churn_probability), 6) as max_churn_probability,
        count(*) filter (where churn_probability >= 0.5) as n_predicted_churn_at_0_5 from scored_current""",
        "scored_current",
    )


def _from_definitions(s: Sql) -> str:
    s.blocks["defs"] = (
        f"{s._defs()} union all select * from (values (16, 'n_SearchMade_last_14d', 'SearchMade', 14)) w",
        [],
    )
    total = "select account_id, metric_time, cast(sum(metric_value) as double) as v from counted where metric_name_id in ({}) group by all"
    return s.query(
        f"""select account_id, metric_time, 13 as metric_name_id, v as metric_value from ({total.format('1, 3')})
        union all select account_id, metric_time, 14, v from ({total.format('1, 3, 5')})
        union all select b.account_id, b.metric_time, 15, coalesce(a.v, 0) / b.v
        from ({total.format('1, 3, 5')}) b left join ({total.format('1, 3')}) a
          on a.account_id = b.account_id and a.metric_time = b.metric_time
        union all select account_id, metric_time, 16, cast(metric_value as double) from counted where metric_name_id = 16""",
        "counted",
    )


CHECKS: dict[str, Callable[[Sql], str]] = {
    "metrics_from_definitions": _from_definitions,
    "metric_grid": lambda s: s.query("select metric_time from grid", "grid"),
    "event_count_metrics": lambda s: s.query("select * from counted", "counted"),
    "total_events_90d": lambda s: _metric("7", s),
    "unique_products_90d": lambda s: _metric("8", s),
    "free_content_actions": lambda s: _metric("9", s),
    "enhanced_reading_actions": lambda s: _metric("10", s),
    "owned_book_ratio": lambda s: _metric("11", s),
    "downloads_per_product": lambda s: _metric("12", s),
    "metric_derived": lambda s: s.query("select * from derived", "derived"),
    "all_metrics": lambda s: s.query("select * from every", "every"),
    "observation": lambda s: s.query(
        "select * replace (cast(observation_date as varchar) as observation_date) from obs", "obs"
    ),
    "metric_snapshot": lambda s: s.query(
        f"select max(metric_time) as metric_time from every where metric_time <= timestamp '{s.cutoff} 00:00:00'",
        "every",
    ),
    "latest_metric_time": lambda s: s.query("select max(metric_time) as metric_time from every", "every"),
    "churn_training_dataset": _training_text,
    "training_dataset_from_metrics": _training_text,
    "current_customer_dataset": lambda s: s.query("select * from current_", "current_"),
    "current_dataset_from_metrics": lambda s: s.query("select * from current_", "current_"),
    "events_per_account_per_month": _per_month,
    "metric_coverage": _coverage,
    "metric_stats_over_time": _stats,
    "metric_qa_series": _series,
    "daily_event_counts": _daily,
    "dataset_summary": _summary,
    "churn_cohorts": _cohorts,
    "churn_cohorts_without_zeros": lambda s: _cohorts(s, "value <> 0"),
    "coerced_features": _coerced,
    "stratified_split": lambda s: s.query("select * from split", "split"),
    "cv_folds": _folds,
    "preprocess_metadata": _metadata,
    "confusion_matrix": lambda s: s.query(
        """select 0 as actual, 0 as predicted, tn as n from cells union all select 0, 1, fp from cells
        union all select 1, 0, fn from cells union all select 1, 1, tp from cells""",
        "cells",
    ),
    "binary_metrics": _binary,
    "classification_report": _report,
    "roc_auc": lambda s: s.query(f"select round({AUC}, 6) as roc_auc", "scored"),
    "roc_curve": _curve,
    "predictions": _predicted,
    "score_histogram": _histogram,
    "score_summary": _score_summary,
    "top_risk": lambda s: _predicted(s, "order by t.churn_probability desc, account_id limit 10"),
    "event_csv_roundtrip": lambda s: s.query(
        "select * replace (coalesce(product_id, -1) as product_id) from ua", "ua"
    ),
    "parquet_export_roundtrip": _training_text,
    "csv_export_roundtrip": lambda s: s.query("select * from current_", "current_"),
}


def _model_facts(s: Sql) -> str:
    return s.query(
        f"""select (select count(*) from current_) as n_scored, 0::bigint as n_outside, 0::bigint as n_contradicting,
        (select count(*) from split where split = 'valid') as n_explained, true as adds_up,
        1::double as total_importance, {prod(len(v) for v in QUERY_GRID.values())}::bigint as n_candidates,
        1::bigint as n_best""",
        "current_",
        "split",
    )


def all_checks() -> dict[str, str]:
    if set(CHECKS) != set(ON_EVENTS):
        raise RuntimeError(f"queries and checks differ: {sorted(set(CHECKS) ^ set(ON_EVENTS))}")
    out = {f"{name}_{log}": make(Sql(log)) for name, make in CHECKS.items() for log in LOGS}
    return out | {"model_facts_o": _model_facts(Sql("o"))}
