"""Column functions: everything here maps columns to a column and never shuffles."""
