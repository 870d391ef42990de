"""The layers in order: bronze records, silver tables, the star schema, and the queries on it."""
