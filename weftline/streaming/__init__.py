"""Structured Streaming operators.

They take streaming frames with an ``event_time`` column of type TIMESTAMP and work on
batch frames as well (a watermark has no effect there).
"""
