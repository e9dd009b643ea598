from stratalake.streaming.follow import follow_event_pages, follow_pharmacy_drops

__all__ = ["follow_event_pages", "follow_pharmacy_drops"]
