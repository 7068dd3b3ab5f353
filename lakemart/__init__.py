"""lakemart: Bronze -> Silver -> Gold building blocks on PySpark DataFrames."""
