"""Named queries over the event table and their SQL counterparts."""
