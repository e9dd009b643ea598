from stratalake.operators.latest import latest_by
from stratalake.operators.lookup import broadcastable, frequent_keys, keys_to_spread, lookup_join
from stratalake.operators.merge import insert_only, unmatched, upsert
from stratalake.operators.paging import next_cursor, page, pages, with_position

__all__ = [
    "broadcastable", "frequent_keys", "insert_only", "keys_to_spread", "latest_by", "lookup_join",
    "next_cursor", "page", "pages", "unmatched", "upsert", "with_position",
]
