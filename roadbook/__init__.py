"""Fleet-telemetry analytics written as Spark DataFrame transformations."""
