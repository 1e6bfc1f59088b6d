"""Layer plans and read queries over gold."""
