"""statflow: cleaning and relating raw statistics tables with Spark DataFrames.

Subpackages: ``functions`` (column expressions), ``operators``
(DataFrame -> DataFrame), ``sources`` (readers and writers), ``plans``
(composite jobs and registered queries), ``streaming`` (incremental landing).
"""

__version__ = "0.1.0"
