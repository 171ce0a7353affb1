"""DataFrame operators: conform, check, select increments, number batches, deliver, look back."""
