"""Column functions: rules, identities, months, salting."""
