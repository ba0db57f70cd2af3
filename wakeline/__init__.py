"""Event-stream analytics for page views and purchases, as PySpark DataFrame functions.

Operators take and return DataFrames.  Those that make sense on an unbounded input accept a
streaming DataFrame as well as a stored table and give the same rows for both.

Input contract: ``user_id string, product_id string, ts timestamp`` plus ``amount_usd`` for
purchases.  ``ts`` is the event time; every ``*_ms`` column of a result is epoch milliseconds.
"""
