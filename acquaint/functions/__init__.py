from acquaint.functions.columns import equals_key, name_sql, shorten, text_sql
from acquaint.functions.typed import cast_fields, typed

__all__ = ["cast_fields", "equals_key", "name_sql", "shorten", "text_sql", "typed"]
