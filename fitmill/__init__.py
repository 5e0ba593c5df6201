"""Score profile documents against requirement texts, as Spark DataFrame operators."""
