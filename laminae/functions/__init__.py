"""Small column helpers shared by the operators."""
