"""widetab: profiling, screening, feature building, sampling, learning,
evaluation and ensembling for wide labelled tables, expressed as Spark
DataFrame jobs.

Every operator takes a DataFrame with an explicit key column and returns a
DataFrame. Row-level work stays on the executors; the driver only ever sees
column-sized (p), bucket-sized (B) or model-sized results.
"""

__version__ = "0.1.0"
