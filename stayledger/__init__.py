"""Booking finance on Spark: per-booking tax, cost and transfer-price measures."""
