"""pacecast.functions."""
