"""Logger files, metadata sheets and stored tables."""
