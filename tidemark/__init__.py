"""tidemark: a Spark-native market-data feature engine.

Layers: landing files -> bronze (all text) -> silver (typed, de-duplicated,
upserted) -> gold marts (rolling / lagged / pivoted / as-of features) -> one
wide feature + label table -> training samples, quality gates, scoring and
published forecasts.  Every step is a ``DataFrame -> DataFrame`` function so
Catalyst plans the whole chain; nothing is collected to the driver.
"""

__all__ = ["session"]
