"""The named analytical queries and the jobs built on them."""
