"""DataFrame operators the job plans are made of."""
