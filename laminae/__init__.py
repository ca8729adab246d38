"""laminae: layered table and stream operators written as plain Spark DataFrame functions."""
