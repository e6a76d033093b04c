"""The batch operators over streaming sources.

No original job streams; this package only shows that the operators take a
streaming DataFrame unchanged.
"""

from quarry.streaming.text_stream import stream_word_count

__all__ = ["stream_word_count"]
