"""cohortlink: Spark-native study-data preparation, QA reporting and record linkage.

Layout: ``functions`` (Column expressions), ``sources`` (readers), ``operators``
(DataFrame -> DataFrame steps), ``plans`` (registered queries over the driver tables),
``streaming`` (incremental intake).
"""

__version__ = "0.1.0"
