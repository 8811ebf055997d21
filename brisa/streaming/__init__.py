"""Incremental re-runs of the forecast scoring job (Structured Streaming)."""

from brisa.streaming.forecast_scoring import score_new_forecasts

__all__ = ["score_new_forecasts"]
