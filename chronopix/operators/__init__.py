"""Statistics over time series of pixels, and the filters and joins around them."""

from chronopix.operators.algebraic import Latest, LogicalAnd, LogicalOr, NoReduction, NormalisedDifference, Oldest, Simple, TasselledCap, WaterSummary
from chronopix.operators.base import STATISTICS, Statistic, reduce_frame, statistic
from chronopix.operators.counters import MaskedMultiCount
from chronopix.operators.external import External, Function
from chronopix.operators.geomedian import GeometricMedian, SpectralMAD
from chronopix.operators.mangrove import MangroveCover
from chronopix.operators.medoid import Medoid, MedoidNoProvenance, MedoidSimple
from chronopix.operators.percentile import InterpolatedPercentile, Percentile, PercentileNoProvenance

__all__ = [
    "STATISTICS", "External", "Function", "GeometricMedian", "InterpolatedPercentile", "Latest", "LogicalAnd", "LogicalOr", "MangroveCover", "MaskedMultiCount", "Medoid", "MedoidNoProvenance",
    "MedoidSimple", "NoReduction", "NormalisedDifference", "Oldest", "Percentile", "PercentileNoProvenance", "Simple", "SpectralMAD", "Statistic", "TasselledCap", "WaterSummary", "reduce_frame", "statistic",
]
