"""panelkit: panel time-series analytics on Spark DataFrames.

A panel is one long table ``(entity, ts, close)``; every per-entity loop of a
single-machine pipeline becomes a window partitioned by ``entity`` or a
``groupBy("entity")`` here.
"""

from panelkit.config import PanelConfig

__all__ = ["PanelConfig"]
