"""Go-to-market sales analytics on Spark DataFrames.

Raw lead, opportunity and closed-deal tables go in; data-quality profiles, cleaned
tables, analytical answers, deal features, customer segments, forecasts, business
measures and report tables come out, all as DataFrames.
"""

from revtrail.params import Params
from revtrail.plans.dataset import Dataset

__all__ = ["Dataset", "Params"]
