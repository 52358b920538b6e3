"""DataFrame operators that take column names, free of any domain knowledge."""
