"""Sinks: append / changelog outputs, JSON document sink, console."""
