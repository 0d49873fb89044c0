"""DataFrame to DataFrame steps, used unchanged by batch and stream."""
