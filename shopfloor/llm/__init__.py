"""Training-data operators: filters, deduplication, search, packing and token files.

Nothing outside this folder imports it; ``registry`` holds its queries and SQL.
"""
