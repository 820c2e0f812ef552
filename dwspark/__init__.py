"""dwspark — batch warehouse ETL, data-quality checks and change detection on Spark DataFrames.

Subpackages:
  sources    readers (CSV/TSV/JSON/Parquet/JDBC, catalog listings)      S1–S11
  sinks      full-refresh loads, verification, JSON reports, step logs  K1–K9
  functions  Column -> Column cleaning functions and row rules           P1–P21, F1–F3, F5
  operators  profiling, validation, joins, aggregates, keys, changes,
             audit, reject accounting, model training                    Q*, J*, A*, O*, U1, C*, R*, F4, L*
  plans      composed warehouse models and end-to-end pipelines         W1–W12
  streaming  running the batch checks per micro-batch (foreachBatch)
"""

__version__ = "0.1.0"
