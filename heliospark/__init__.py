"""heliospark: photovoltaic fleet analytics on Spark DataFrames."""
