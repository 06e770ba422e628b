"""Query bindings and the registry of query keys."""
