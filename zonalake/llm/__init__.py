"""Operators for preparing training text: filtering, de-duplication, extraction, mixing and output.

Nothing outside this folder, `corpus_pipeline.py` and the driver contract imports it.
"""
