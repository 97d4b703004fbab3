"""pacecast.sources."""
