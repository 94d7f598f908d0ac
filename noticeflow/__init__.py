"""Notice collection, matching and validation as PySpark operators."""
