"""opslake: supply-chain analytics as plain Spark DataFrame and streaming jobs."""

__version__ = "0.1.0"
