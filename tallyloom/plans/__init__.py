"""End-to-end cleaners for the retail tables, composed from the operators."""
