"""Device telemetry on Spark: cleaning, profiling, cycles, lags, scaling, training and scoring."""

from devicepulse.spec import TelemetrySpec

__all__ = ["TelemetrySpec"]
