"""panelforge: entity-by-day panel analytics and forecasting studies on Spark."""

__version__ = "0.1.0"
