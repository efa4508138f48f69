"""The registered queries, the files they stage, and the SQL they are compared with."""
