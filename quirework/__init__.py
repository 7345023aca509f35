"""Set-at-a-time checks and planning for source-bound document processing, on PySpark DataFrames."""
