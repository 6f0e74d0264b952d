"""Lifecycle analytics on Spark: records that open, may close, and can run late."""

from caselens.session import build_session, pin_utc
from caselens.spec import FeatureConfig, LifecycleSpec

__all__ = ["FeatureConfig", "LifecycleSpec", "build_session", "pin_utc"]
