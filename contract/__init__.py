"""The operators as queries over the given tables, with equivalent SQL."""
