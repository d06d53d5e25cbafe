"""The pipeline driven by a file stream: one micro-batch and one run per new file."""

from .inbox import inbox_status, start_inbox

__all__ = ["inbox_status", "start_inbox"]
