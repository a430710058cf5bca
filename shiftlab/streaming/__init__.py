"""Shift changes as telemetry arrives."""
