"""DataFrame operators composed from Spark built-ins."""
