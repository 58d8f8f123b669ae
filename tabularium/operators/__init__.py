"""DataFrame operators over documents, regions, groups and records."""
