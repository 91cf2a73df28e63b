"""Climate and crop analytics as plain Spark DataFrame transformations."""
