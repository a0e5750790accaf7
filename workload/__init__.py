"""The registered queries: input views over the given tables, queries, SQL oracles."""
