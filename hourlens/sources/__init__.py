"""Readers, sinks, schema checks and the driver-table views."""
