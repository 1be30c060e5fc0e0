"""The checks and the relational building blocks under them."""
