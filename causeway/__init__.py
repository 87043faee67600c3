"""Causal panel analytics on PySpark."""
