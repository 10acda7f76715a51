"""Training-data operators: tokenising, deduplication, quality, safety, archives, chat.

Nothing outside this package imports it; its queries and SQL are in
``queries`` and the entry module adds them when the package is present.
"""
