"""DataFrame operators for preparing, fitting and measuring models on Spark.

Every operator takes and returns DataFrames; expression builders take and
return Columns.  Plans stay lazy unless a docstring says that a job runs.
"""
