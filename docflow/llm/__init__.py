"""Training-data operators: ten corpus operators that share no code with the rest of the package."""
