"""A PySpark engine that turns many small irregular tables into one canonical dataset."""
