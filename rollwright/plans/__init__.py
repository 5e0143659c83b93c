"""Jobs that chain the operators. Column names, code lists and formats are parameters."""
