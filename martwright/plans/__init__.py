"""The layered tables: one function per table, and the run that writes them."""
