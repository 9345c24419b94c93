"""Writers."""

from weekloom.sinks.export import export_cleaned, export_features, export_version

__all__ = ["export_cleaned", "export_features", "export_version"]
