"""DataFrame operators over telemetry, window statistics, panel status and tilt candidates."""
