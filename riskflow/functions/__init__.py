"""Column functions: null-on-error casts, IPv4 handling, null tokens and the JSON wire format."""
