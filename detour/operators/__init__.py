"""DataFrame -> DataFrame building blocks.

Row-level operators (``status.events_from_documents``, ``parse``, ``alerts`` joined to
a static options table) run unchanged on batch and streaming DataFrames. Graph
building, upserts, paths, options and reports use windows and global aggregates, so
they run on batch DataFrames: on written tables, or on each micro-batch inside
``foreachBatch``.
"""
