"""What is built from what: the mart list, and the steps of a run."""
