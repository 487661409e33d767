"""riskloom: transaction-risk analytics, corpus retrieval and model evaluation as Spark jobs."""
