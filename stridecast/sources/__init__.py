"""Reading and writing models and results."""
