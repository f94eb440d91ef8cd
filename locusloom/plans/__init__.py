"""The operators chained into whole studies."""
