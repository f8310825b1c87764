"""Layer plans that chain the operators from raw tables to served results."""
