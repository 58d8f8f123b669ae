"""Plan tables: who proposes them and how they are applied in turn."""
