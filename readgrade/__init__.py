"""Readability and levelled-text analytics on Spark DataFrames.

``functions``  column expressions (tokenising, tagging, formulas, digits)
``sources``    scans: feature tables, word lists, text files, frequencies
``operators``  DataFrame -> DataFrame building blocks
``plans``      flows composed from the operators
"""
