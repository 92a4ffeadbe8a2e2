"""Column -> Column helpers, one native expression each."""
