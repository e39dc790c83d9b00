"""Plans: the layered pipeline and the registered query catalog."""
