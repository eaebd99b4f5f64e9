"""Steps from order rows to the return marts."""
