"""Shipment analytics written as PySpark DataFrame functions."""
