"""Models in dependency order, and the registered queries."""
