"""Public-opinion text analytics as PySpark DataFrame operators."""
