"""Column helpers and ranking building blocks shared by the operators."""
