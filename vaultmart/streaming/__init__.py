"""Micro-batch feeding of the batch pipeline (Structured Streaming).

The reference runs once a day; the loaders take a staged batch and what the
target holds, so a file stream of raw feed drops can drive them through
``foreachBatch`` with the stream's checkpoint recording which drops are done.
"""

from vaultmart.streaming.micro_batch import feed_stream, micro_batch_loader

__all__ = ["feed_stream", "micro_batch_loader"]
