"""Support-conversation analytics as plain DataFrame operators."""

from threadlens.config import Settings

__all__ = ["Settings"]
