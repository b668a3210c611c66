"""Plan building blocks shared by operators."""
