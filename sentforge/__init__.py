"""sentforge: Spark-native operators for building parallel-text corpora.

Every operator is a pure function ``DataFrame -> DataFrame`` (plus plain
parameters).  Nothing here creates a session, collects unbounded data to the
driver, or runs per-row Python in a hot path unless documented.
"""

__version__ = "0.1.0"
