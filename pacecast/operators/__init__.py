"""pacecast.operators."""
