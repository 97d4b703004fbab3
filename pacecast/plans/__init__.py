"""pacecast.plans."""
