"""Text-classification analytics as Spark DataFrame operators."""
