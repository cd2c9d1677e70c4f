"""Column functions: key normalisation, similarity, hashing and text variation."""
