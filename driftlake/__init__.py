"""Clock-drift correction and time-series quality operators on Spark DataFrames."""
