"""Batch and streaming analytics for a bank, insurance and mobile-money group.

Raw CSV files and JSON messages become bronze, silver and gold tables.  Every
operator is a function from DataFrame to DataFrame; see README.md.
"""
