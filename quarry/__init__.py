"""quarry: DataFrame -> DataFrame analytics operators on Spark.

Text statistics and sentiment, entity co-mention graphs, technical
time-series features, regression diagnostics, tabular cleaning and
binning, model evaluation, categorical trees and path / assignment
costs, all written as Spark SQL plans.
"""

__version__ = "0.1.0"
