"""Ready-made marts; every function takes and returns DataFrames."""
