"""Column functions: text, numbers, dates, and SQL-bodied functions."""
