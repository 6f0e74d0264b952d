"""Column names of a lifecycle table and the settings of a feature build."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class LifecycleSpec:
    key: str = "unique_key"
    start: str = "created_date"
    end: str = "closed_date"
    status: str = "status"
    closed_value: str = "Closed"
    group: str = "agency"
    subgroup: str = "complaint_type"
    detail: str = "descriptor"
    region: str = "borough"
    channel: str = "channel"
    is_open: str = "is_open"
    hours: str = "resolution_hours"

    @property
    def pair(self) -> list[str]:
        return [self.group, self.subgroup]


@dataclass(frozen=True)
class FeatureConfig:
    """Split ranges are half-open; rows outside every range get a NULL split."""

    splits: dict[str, tuple[str, str]]
    observed_at: str
    min_group_n: int = 200
    rare_min_n: int = 200
    history_days: int = 28
    flow_seconds: int = 86_400
    quantile: float = 0.75
    replay: tuple[str, str] | None = None
    spec: LifecycleSpec = field(default_factory=LifecycleSpec)
