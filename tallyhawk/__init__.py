"""tallyhawk: find rare, anomalous records in wide event-count tables, on Spark."""
