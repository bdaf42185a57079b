"""Tramline: a transit-data analytics engine on the Spark DataFrame API."""
