from stratalake.sources.csv_drop import csv_drops, csv_drops_with_breaks, split_incomplete, stream_csv_drops
from stratalake.sources.csv_records import csv_records
from stratalake.sources.json_pages import broken_pages, event_pages, events_since, split_pages, stream_event_pages
from stratalake.sources.tables import as_text, changed_since, jdbc_table

__all__ = [
    "as_text", "broken_pages", "changed_since", "csv_drops", "csv_drops_with_breaks", "csv_records", "event_pages", "events_since", "jdbc_table",
    "split_incomplete", "split_pages", "stream_csv_drops", "stream_event_pages",
]
