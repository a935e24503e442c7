"""Demand-planning analytics on Spark: forecasts beside actuals, in one currency, at several date grains."""
