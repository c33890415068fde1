"""Relations of solutions and the operators on them."""
