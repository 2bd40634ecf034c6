"""Registered queries, the SQL they are checked against, and the telemetry feed they read."""
