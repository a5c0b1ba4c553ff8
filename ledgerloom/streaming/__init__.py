"""Event-driven maintenance as Structured Streaming jobs over file sources."""
