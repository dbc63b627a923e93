"""Plan-level helpers: materialisation, graph components, key indexing, query registry."""
