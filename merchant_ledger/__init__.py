"""Merchant totals over payment-order change events, as Spark DataFrame jobs."""
