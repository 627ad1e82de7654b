"""Named queries and their SQL counterparts."""
