"""Training-data operators and the pipeline built of them. Nothing outside this package imports it."""
