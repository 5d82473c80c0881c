"""Structured Streaming jobs over shipment events."""
