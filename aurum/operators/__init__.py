"""DataFrame -> DataFrame operators: harmonise, block, score, cluster, survive,
score quality, version, serve, check."""
