"""zonelake: data-lake pipelines and analytics as plain Spark DataFrame functions."""
