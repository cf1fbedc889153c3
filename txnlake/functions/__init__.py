"""Column expressions: money, time, text rules and the review flag."""
