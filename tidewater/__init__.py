"""Spark-first medallion lakehouse: change records in, earnings views out.

Everything here is DataFrame, SQL or Structured Streaming code.  There are no
Python UDFs, no RDD code and no custom Catalyst rules.
"""
