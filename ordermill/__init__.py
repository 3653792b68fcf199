"""ordermill: order analytics for restaurant chains as PySpark DataFrame functions.

Raw line items, options and a calendar are cleaned, joined into an order fact
with four dimensions, and turned into customer, sales, loyalty, location and
upsell metrics, reports and data audits.
"""
