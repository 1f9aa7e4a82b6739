"""The stateless text functions over streaming tables."""
