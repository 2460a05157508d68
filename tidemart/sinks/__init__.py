"""Writers of facts, routed messages, and keyed tables."""
