"""Table operators: each takes DataFrames and returns DataFrames or fitted stages."""
