"""Panel time-series analytics on PySpark.

``epipanel.operators`` holds the analyses (DataFrame -> DataFrame),
``epipanel.functions`` their column expressions, ``epipanel.sources`` the
file readers/writers, ``epipanel.streaming`` incremental versions and
``epipanel.plans`` the query catalogue and the whole-application report.
"""

__version__ = "0.1.0"
