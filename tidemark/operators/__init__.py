"""One module per family of analyses; every operator maps DataFrames to a DataFrame."""
