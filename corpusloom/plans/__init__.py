"""End-to-end flows and the queries over the driver tables."""
