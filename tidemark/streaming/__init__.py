"""Incremental loading.

The original job has no stream processing: no readStream, watermark, state or
late data.  Its only incremental element is a bounded pull of the rows
changed since a stored start time up to the job start; that window logic
lives here (``incremental``).
"""
