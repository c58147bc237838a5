"""canopy: survey analytics and weighted decision trees as Spark jobs.

Sub-packages
------------
sources     reading the survey (from the driver tables or CSV), sinks, reports
functions   column expressions: ordinal maps, codes, dummies, bins, feature bundles
operators   profiles, splits and folds, metrics, tree growth / pruning / scoring
plans       grid search, cross-validation, nested CV, the query catalogue
streaming   scoring a stream with a saved tree
"""

__version__ = "0.1.0"
