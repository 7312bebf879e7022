"""wardflow: arrival, wait, occupancy and forecast analytics for care flow data on Spark."""

__version__ = "0.1.0"
