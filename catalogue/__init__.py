"""The registered queries, their inputs over the test tables, and their oracles."""
