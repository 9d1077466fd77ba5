"""Dataset wiring (which dataset reads which) and the registered queries."""
