"""Customer-retention analytics as composable Spark DataFrame operators."""

from tidemark.spec import DEFAULT_SPEC, ChurnSpec, MetricDefinition

__all__ = ["DEFAULT_SPEC", "ChurnSpec", "MetricDefinition"]
