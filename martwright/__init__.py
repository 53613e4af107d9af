"""Customer, delivery, messaging, geo and payment marts as Spark DataFrame code."""

__version__ = "0.1.0"
