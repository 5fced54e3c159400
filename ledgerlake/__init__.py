"""ledgerlake: a Spark-native toolkit for keeping a dimensional warehouse.

Operators are functions from DataFrames to DataFrames, driven by declarative
specs (``ledgerlake.spec``).  Only ``sources.store`` and ``plans.jobs`` write.
"""

__version__ = "0.1.0"
