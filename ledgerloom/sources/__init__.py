"""Reading inputs and storing results."""
