"""Statistics over streams of observations."""
