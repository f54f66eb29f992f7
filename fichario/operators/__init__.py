"""Jobs over DataFrames: every operator takes DataFrames and returns a DataFrame."""
