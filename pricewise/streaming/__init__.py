"""Structured Streaming entry points.

The original work is batch only; the quote chain is the one step that
serves requests as they arrive, so it is offered as a stream-static job.
"""

from pricewise.streaming.quotes import start_quote_stream

__all__ = ["start_quote_stream"]
