"""Dataset jobs: thin compositions of the operators, one module per kind of source."""
