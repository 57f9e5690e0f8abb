"""No streaming operators.

The mined system is bounded only: it has no watermark, window, state or
late-data handling, so nothing is built here.  A stream can still be mined
per micro-batch by calling the batch miners inside ``foreachBatch``.
"""
