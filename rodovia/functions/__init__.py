"""Column builders: cleaning rules, measures and calendar attributes."""
