"""What to measure: metric definitions, label rule and grid step.

Everything downstream is driven by a :class:`ChurnSpec`; no operator hard-codes
a metric id, an event type or a date.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, replace

BASIC = "basic_event_count"
TOTAL_EVENTS = "total_events"
UNIQUE_PRODUCTS = "unique_products"
SUM_OF_METRICS = "total_metric"
RATIO = "ratio_metric"


@dataclass(frozen=True)
class MetricDefinition:
    """One row of the metric table.

    ``components`` (metric ids) feed a ``total_metric``; ``numerator`` and ``denominator`` (metric ids)
    feed a ``ratio_metric``. All of them are counts: any kind but a ratio.
    """

    metric_name_id: int
    metric_name: str
    event_type: str
    lookback_days: int
    metric_kind: str
    components: tuple[int, ...] = ()
    numerator: int | None = None
    denominator: int | None = None

    @property
    def feature(self) -> str:
        return self.metric_name.lower()

    @property
    def sources(self) -> tuple[int | None, ...]:
        """The metrics that this one is made of."""
        if self.metric_kind == SUM_OF_METRICS:
            return self.components
        return (self.numerator, self.denominator) if self.metric_kind == RATIO else ()


def in_order(definitions: tuple[MetricDefinition, ...]) -> tuple[MetricDefinition, ...]:
    """The definitions, each behind those that it is made of; otherwise in the order given."""
    by_id, placed, out = {d.metric_name_id: d for d in definitions}, set(), []

    def add(d: MetricDefinition, path: tuple[int, ...]) -> None:
        if d.metric_name_id in path:
            raise ValueError(f"metrics are made of each other: {[*path, d.metric_name_id]}")
        if d.metric_name_id in placed:
            return
        for i in d.sources:
            if i not in by_id:
                raise ValueError(f"metric {d.metric_name_id}: made of metric {i}, which is not defined")
            add(by_id[i], (*path, d.metric_name_id))
        placed.add(d.metric_name_id)
        out.append(d)

    for d in definitions:
        add(d, ())
    return tuple(out)


# The twelve metrics.
METRIC_DEFINITIONS = (
    MetricDefinition(1, "n_ReadingOwnedBook_last_28d", "ReadingOwnedBook", 28, BASIC),
    MetricDefinition(2, "n_EBookDownloaded_last_28d", "EBookDownloaded", 28, BASIC),
    MetricDefinition(3, "n_ReadingFreePreview_last_28d", "ReadingFreePreview", 28, BASIC),
    MetricDefinition(4, "n_HighlightCreated_last_28d", "HighlightCreated", 28, BASIC),
    MetricDefinition(5, "n_SearchMade_last_28d", "SearchMade", 28, BASIC),
    MetricDefinition(6, "n_BookmarkCreated_last_28d", "BookmarkCreated", 28, BASIC),
    MetricDefinition(7, "n_total_events_last_90d", "*", 90, TOTAL_EVENTS),
    MetricDefinition(8, "n_unique_products_last_90d", "*", 90, UNIQUE_PRODUCTS),
    MetricDefinition(9, "n_free_content_actions_last_28d", "*", 28, SUM_OF_METRICS, components=(3,)),
    MetricDefinition(10, "n_enhanced_reading_actions_last_28d", "*", 28, SUM_OF_METRICS, components=(4,)),
    MetricDefinition(
        11, "pct_reading_owned_book_events_last_28d", "*", 28, RATIO, numerator=1, denominator=7
    ),
    MetricDefinition(
        12, "n_downloads_per_unique_product_last_90d", "*", 90, RATIO, numerator=2, denominator=8
    ),
)

# The order of the feature columns, by metric id.
FEATURE_ORDER = (2, 1, 3, 5, 4, 6, 7, 8, 9, 10, 11, 12)

# Event types that count as being retained.
RETENTION_EVENT_TYPES = ("ReadingOwnedBook", "EBookDownloaded")

# Event types reported by the daily series.
EVENT_TYPES = (
    "AddOrUpdateCoupon",
    "AddProductOffering",
    "BookmarkCreated",
    "CommentCreated",
    "CrossReferenceTermOpened",
    "DashboardLivebookLinkOpened",
    "EBookDownloaded",
    "EBookRegistration",
    "ExerciseSolved",
    "FirstLivebookAccess",
    "FirstManningAccess",
    "FreeContentCheckout",
    "GoToManningShoppingCart",
    "HighlightCreated",
    "LivebookAccountConfirmation",
    "LivebookLogin",
    "LivebookRegistration",
    "NoteCreated",
    "OrderConfirmationLivebookLinkOpened",
    "ProductLiveaudioUpsell",
    "ProductLookInsideLivebookLinkOpened",
    "ProductSeeFreeLinkOpened",
    "ProductTocLivebookLinkOpened",
    "ReadingFreePreview",
    "ReadingOpenChapter",
    "ReadingOwnedBook",
    "RemoveProductOffering",
    "SearchMade",
    "SearchResultOpened",
    "ShareableLinkCreated",
    "ShareableLinkOpened",
    "SherlockHolmesClueFound",
    "UnknownOriginLivebookLinkOpened",
    "UpvoteGiven",
    "WishlistItemAdded",
)

TARGET = "is_churn"
TRAIN_IDS = ("account_id", "observation_date")
CURRENT_IDS = ("account_id", "metric_time")


@dataclass(frozen=True)
class ChurnSpec:
    cutoff: dt.date = dt.date(2020, 3, 1)
    step_days: int = 7
    retention_event_types: tuple[str, ...] = RETENTION_EVENT_TYPES
    definitions: tuple[MetricDefinition, ...] = METRIC_DEFINITIONS
    feature_order: tuple[int, ...] = FEATURE_ORDER
    event_types: tuple[str, ...] = EVENT_TYPES
    by_id: dict[int, MetricDefinition] = field(init=False, repr=False, compare=False)

    def __post_init__(self) -> None:
        by_id = {d.metric_name_id: d for d in self.definitions}
        if len(by_id) != len(self.definitions):
            raise ValueError("metric_name_id must be unique")
        if len({d.metric_name for d in self.definitions}) != len(self.definitions):
            raise ValueError("metric_name must be unique")
        unknown = sorted(set(self.feature_order) - set(by_id))
        if unknown:
            raise ValueError(f"feature_order names unknown metric ids: {unknown}")
        for d in self.definitions:
            self._check(d, by_id)
        in_order(self.definitions)  # an error if there is none
        object.__setattr__(self, "by_id", by_id)

    @staticmethod
    def _check(d: MetricDefinition, by_id: dict[int, MetricDefinition]) -> None:
        if d.lookback_days < 1:
            raise ValueError(f"metric {d.metric_name_id}: lookback_days must be positive")
        if d.metric_kind == SUM_OF_METRICS and not d.components:
            raise ValueError(f"metric {d.metric_name_id}: a total_metric needs components")
        if d.metric_kind == RATIO:
            if d.numerator not in by_id or d.denominator not in by_id:
                raise ValueError(f"metric {d.metric_name_id}: a ratio_metric needs numerator and denominator")
        if any(by_id[i].metric_kind == RATIO for i in d.sources if i in by_id):
            raise ValueError(f"metric {d.metric_name_id}: made of a ratio, which is no count")
        if d.metric_kind not in (BASIC, TOTAL_EVENTS, UNIQUE_PRODUCTS, SUM_OF_METRICS, RATIO):
            raise ValueError(f"metric {d.metric_name_id}: unknown kind {d.metric_kind!r}")

    @property
    def base_ids(self) -> tuple[int, ...]:
        """Every definition takes part in the event-type join, whatever its kind."""
        return tuple(d.metric_name_id for d in self.definitions)

    @property
    def derived_ids(self) -> tuple[int, ...]:
        return tuple(d.metric_name_id for d in self.definitions if d.metric_kind != BASIC)

    @property
    def features(self) -> list[str]:
        return [self.by_id[i].feature for i in self.feature_order]

    def at(self, cutoff: dt.date) -> ChurnSpec:
        return replace(self, cutoff=cutoff)


DEFAULT_SPEC = ChurnSpec()
