"""Streaming telemetry and interaction-graph analytics as plain DataFrame functions."""
