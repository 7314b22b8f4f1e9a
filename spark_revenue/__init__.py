"""Revenue, churn and billing-leakage analytics as lazy Spark DataFrame jobs."""
