"""Customer 360 analytics for retail-bank portfolios, written as PySpark DataFrame transformations."""
