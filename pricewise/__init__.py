"""pricewise — Spark-native pricing and seasonality engine.

Turns tables of individual sales into cleaned records, model features and
index- and season-adjusted prices. Every operator is a lazy
``DataFrame -> DataFrame`` function built from Spark SQL expressions,
joins, aggregates and windows; Spark ML is used for the regression models.
"""

from pricewise.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
