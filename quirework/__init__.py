"""Document-layout analytics as DataFrame transformations."""

__version__ = "0.1.0"
