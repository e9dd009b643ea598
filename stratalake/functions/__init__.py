from stratalake.functions.casts import iso_text, safe_date, safe_decimal, safe_int, safe_timestamp

__all__ = ["iso_text", "safe_date", "safe_decimal", "safe_int", "safe_timestamp"]
