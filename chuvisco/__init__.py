"""Layered batch lake jobs over nested time-series documents, on the Spark DataFrame API."""
