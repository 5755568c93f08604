"""Daily risk panels on Spark: hourly drivers and dated events in, calibrated next-day risk out."""
