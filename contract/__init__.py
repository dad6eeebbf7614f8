"""The queries behind ``__spark_entry__.py``: library operators over the driver's tables."""
