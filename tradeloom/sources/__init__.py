"""Reading the marketplace tables and staging the joined order lines."""
