"""Landing, shaping, refreshing and exporting tables."""
