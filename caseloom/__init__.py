"""Case document analytics on PySpark."""
