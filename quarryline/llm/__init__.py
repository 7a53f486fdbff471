"""Training-data operators: extraction, scans, dedup, decontamination, sharding and packing.

Nothing outside this folder imports it; its queries are in ``queries.py``.
"""
