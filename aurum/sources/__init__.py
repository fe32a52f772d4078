"""Sources: derived identity feeds, CSV/JSON file sources, event topics."""
