"""Training-data operators: each module holds one operator with its own general interface."""
