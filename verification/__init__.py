"""The queries under test and, for each, the same question in SQL for another engine."""
