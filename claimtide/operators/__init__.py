"""DataFrame -> DataFrame operators of the claim model."""
