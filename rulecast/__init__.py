"""Advertising segmentation rules as Spark DataFrame jobs."""
