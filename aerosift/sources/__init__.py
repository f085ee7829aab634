"""Sources: landed state payloads, raw table, fixture adapter."""
