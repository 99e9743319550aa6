class SyncError(ValueError):
    """A read or a write that is refused before any job starts."""
