"""Request-log and distributed-trace analytics as PySpark DataFrame operators."""
