"""Micro-batch refresh of the warehouse, and streaming marts."""
