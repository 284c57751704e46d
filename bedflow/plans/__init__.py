"""Model plans: each composes operators into one lazy DataFrame."""
