"""DataFrame operators: schemas, unions, sequences, merges, constraints, profiles, catalogs."""
