"""Named query plans: the registry of keys, their Spark builders and oracles."""
