"""Tidewell: e-commerce event analytics written as Spark DataFrame operators."""
