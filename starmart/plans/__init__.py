"""Table recipes, the load runs made of them, and the registered queries."""
