"""siltstone - DataFrame operators for a document lakehouse on Apache Spark.

Layered cleaning of raw text, vector search on Parquet, reshaping, calendars
and data-quality checks.  Every public function takes and returns DataFrames or
Columns; Catalyst plans and runs them.
"""
