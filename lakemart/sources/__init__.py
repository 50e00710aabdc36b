from .tables import TABLES, load
from .events import bronze_from_tables, read_events_csv, with_lineage, events_from_orders
from .stream import read_event_stream, stream_events_from_bronze

__all__ = ["TABLES", "load", "bronze_from_tables", "read_events_csv", "with_lineage",
           "events_from_orders", "read_event_stream", "stream_events_from_bronze"]
