"""The six models and the ordered run that builds them."""
