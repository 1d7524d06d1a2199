"""Daily curation of customer reviews, expressed as Spark DataFrame operators.

``functions``  column expressions (text folding, path capture, formats)
``sources``    readers that turn a missing path into a typed empty frame
``operators``  standardise, conform, merge with history, quality checks
``sinks``      partitioned Parquet and metrics tables
``plans``      the whole daily run and its metrics documents
``catalog``    the operators run over the test tables, with SQL oracles
"""

__version__ = "0.1.0"
