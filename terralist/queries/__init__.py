"""The registered queries; importing this package fills the registry."""

import importlib

from terralist.queries.registry import ORACLES, QUERIES

for _module in ("tracking", "cleaning", "spatial", "text", "profiling", "publishing"):
    importlib.import_module(f"terralist.queries.{_module}")
