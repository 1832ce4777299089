"""Moderation analytics for game chat, written as Spark jobs."""

__version__ = "0.1.0"
