"""Input derivation, registered queries and their SQL counterparts."""
