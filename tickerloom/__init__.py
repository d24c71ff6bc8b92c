"""Daily price panels (symbol x date) on Spark."""
