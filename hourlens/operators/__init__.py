"""Table-to-table operators.  Every function takes and returns DataFrames."""
