"""Game telemetry lakehouse on Spark: landing, cleaned events, sessions, marts."""
