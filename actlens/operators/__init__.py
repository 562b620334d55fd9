"""DataFrame -> DataFrame operators of the activity analysis."""

from actlens.operators import anomaly, explore, funnel, ordinal, prepare, quantiles, report, sequence

__all__ = ["anomaly", "explore", "funnel", "ordinal", "prepare", "quantiles", "report", "sequence"]
