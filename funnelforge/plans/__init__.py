"""End-to-end plans: the model graph, golden metrics, query catalogue, oracles."""
