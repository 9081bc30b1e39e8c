"""A PySpark-native engine for record extraction, convergence and serving."""
