"""Readers."""

from weekloom.sources.read import load_data, read_folder
from weekloom.sources.versions import read_latest

__all__ = ["load_data", "read_folder", "read_latest"]
