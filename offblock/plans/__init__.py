"""Stage chains (silver, gold, train, predict) and the registered query catalog."""
