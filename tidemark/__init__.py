"""tidemark: Spark-native loading, cleaning, quality checks and KPIs for e-commerce tables."""
