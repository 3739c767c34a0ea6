"""Column functions: type decoders, log positions, identifiers."""
