"""Reports composed from the operators, and the driver-table analog queries."""
