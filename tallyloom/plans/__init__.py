"""The reports. Each module has a parameter class and ``report(tables, params) -> DataFrame``."""
