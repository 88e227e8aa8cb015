"""skulink: product-catalogue matching as Spark DataFrame plans."""

__version__ = "0.1.0"
