"""Connected components, as the operators here import them."""

from mailtriage.operators.graph import components

__all__ = ["components"]
