"""Product-funnel and experiment analytics as plain Spark DataFrame functions."""

from paceline.spec import DEFAULT_EXPERIMENT, DEFAULT_FUNNEL, ExperimentSpec, FunnelSpec, Rate, Step

__all__ = [
    "DEFAULT_EXPERIMENT",
    "DEFAULT_FUNNEL",
    "ExperimentSpec",
    "FunnelSpec",
    "Rate",
    "Step",
]
