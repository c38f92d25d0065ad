"""Feature analytics and model monitoring as DataFrame-to-DataFrame operators."""

__version__ = "0.1.0"
