"""Map-tile analytics on Spark DataFrames."""
