"""Topics, dimension tables and JDBC tables."""
