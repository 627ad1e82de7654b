"""holdfast: customer-retention analytics as plain Spark DataFrame functions."""
