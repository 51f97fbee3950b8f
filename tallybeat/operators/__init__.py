"""Building blocks: each takes DataFrames and returns DataFrames."""
