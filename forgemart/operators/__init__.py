"""Relational building blocks that hold up when one key owns a large share of the rows."""
