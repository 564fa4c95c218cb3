"""Retail-trade and fuel-price star schema on Spark."""
