"""starload: a PySpark toolkit for a layered sales warehouse (see README)."""
