"""Layered campaign-spend and customer-feedback analytics on Spark."""
