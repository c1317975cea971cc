"""Structured Streaming forms of the jobs.

Every job takes a streaming DataFrame with an event-time column ``ts`` of
type TIMESTAMP (see :func:`clickwave.streaming.sources.as_stream_time`) and
returns a streaming DataFrame, or starts a query whose ``foreachBatch``
keeps a small table of results.  Finished windows come out in append mode.
Without late rows a streamed result equals the batch result restricted to
closed windows; a late row counts in the windows that are still open.
"""
