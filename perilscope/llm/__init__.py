"""Operators for preparing large text corpora (mixing, scanning, scoring, de-duplication, packing).

Nothing else in the library imports this subpackage.
"""
