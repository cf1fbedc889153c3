"""Where data comes from and where it is kept: events, rates, tables, test feeds."""
