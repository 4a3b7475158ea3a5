"""Fleet telematics analytics as PySpark DataFrame operators."""

from fleetgauge.settings import RiskSettings, StreamSettings, SuspensionTier, ZoneBox

__all__ = ["RiskSettings", "StreamSettings", "SuspensionTier", "ZoneBox"]
