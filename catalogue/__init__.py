"""The registered queries: the given tables seen as retail entities, one query per operator."""
