"""Streaming.

The study this library re-implements has no streams: no watermark, window,
state or late data anywhere.  Nothing is built here.  The batch operators are
plain DataFrame functions, so a caller who needs them on a stream can apply
them per micro-batch with ``writeStream.foreachBatch``; the library ships no
streaming operator of its own.
"""
