"""End-to-end flows, and where their intermediate tables are kept."""
