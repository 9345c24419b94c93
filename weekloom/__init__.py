"""weekloom: raw sales transactions to forecast-ready weekly series, on Spark."""

from weekloom.columns import SalesColumns

__all__ = ["SalesColumns"]
