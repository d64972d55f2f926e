"""Proof-gated order analytics as Spark DataFrame jobs.

An order counts only when an invoice document backs it. The package loads the
raw tables, links documents to orders, certifies orders, rebuilds the golden
tables with an error log beside them, recovers late documents and computes
the business marts.
"""
