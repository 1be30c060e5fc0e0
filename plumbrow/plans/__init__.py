"""Running checks together, and keeping their results."""
