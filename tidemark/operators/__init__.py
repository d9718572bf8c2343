"""DataFrame to DataFrame operators of the batch stages."""
