"""Bronze, silver and gold tables of retail transactions and web clickstream, as Spark operators.

Every operator is a lazy ``DataFrame -> DataFrame`` function; actions happen only in
``millrace.plans`` (writers) and ``millrace.streaming`` (landing ingest).
"""

__version__ = "0.1.0"
