"""The silver and gold models, the served queries and the daily run."""
