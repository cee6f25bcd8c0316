"""Training-data operators: ten steps of a corpus pipeline and their queries."""
