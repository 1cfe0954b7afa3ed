"""End-to-end flows and the SQL surface."""
