"""The registered queries: each over the test tables, with its SQL twin."""
