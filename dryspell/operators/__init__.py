"""DataFrame -> DataFrame operators, one module per reference stage."""
