"""Quality-gated trip analytics on Spark DataFrames."""

from waybill.profile import FlowLimits, Period, Profile, Thresholds

__all__ = ["FlowLimits", "Period", "Profile", "Thresholds"]
