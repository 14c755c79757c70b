"""martloom: reference-data and spend marts as Spark plans."""
