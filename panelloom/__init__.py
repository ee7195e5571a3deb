"""Daily-panel analytics and training-data operators on PySpark."""
