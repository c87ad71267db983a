"""Sources: driver tables, streaming line readers, ordered replay."""

from .tables import (embedding_points, event_lines, event_points,
                     lineitem_points, table)

__all__ = ["embedding_points", "event_lines", "event_points",
           "lineitem_points", "table"]
