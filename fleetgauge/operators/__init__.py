"""DataFrame operators; none runs an action."""
