"""tessera: governed business metrics as lazy Spark DataFrames."""
