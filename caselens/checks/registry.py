"""All registered queries by name."""

from __future__ import annotations

from caselens.checks import (
    feature_cases,
    flow_cases,
    metric_cases,
    model_cases,
    quality_cases,
    serving_cases,
    stream_cases,
    target_cases,
)
from caselens.checks.common import Case

CASES: dict[str, Case] = {}
for _module in (quality_cases, target_cases, flow_cases, feature_cases, metric_cases, serving_cases, model_cases, stream_cases):
    CASES.update(_module.CASES)
