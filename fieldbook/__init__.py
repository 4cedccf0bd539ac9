"""fieldbook: hunting and fishing license metrics as PySpark jobs."""
