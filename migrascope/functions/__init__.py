"""Column-expression builders: no DataFrames, no actions."""
