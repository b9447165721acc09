"""Fund analytics on Spark: landing, cleaning, star schema, period KPIs and relationship risk."""
