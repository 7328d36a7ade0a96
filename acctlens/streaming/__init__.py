"""Streaming forms of the batch operators.

The original models are batch only. ``usage`` keeps the daily usage fact
(M10) current while usage events keep arriving.
"""
