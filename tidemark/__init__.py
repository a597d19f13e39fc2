"""Multi-series time-series analytics as plain ``DataFrame -> DataFrame`` functions."""
