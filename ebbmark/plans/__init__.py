"""Jobs put together from the operators: the batch export."""
