"""Structured Streaming twins (see :mod:`cohortix.streaming.twins`)."""
