"""The versioned store, the two workflows and their runtime."""
