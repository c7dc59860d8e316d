"""The driver tables seen as service tables, and the registered queries over them."""
