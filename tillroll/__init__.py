"""tillroll — a retail transactions lakehouse expressed as Spark DataFrame plans.

Layers: ``sources`` (scans, fixtures, state), ``functions`` (Column builders),
``operators`` (DataFrame -> DataFrame steps), ``plans`` (composite jobs and the
query registry), ``streaming`` (Structured Streaming job).
"""
__all__ = ["config", "schemas", "session"]
