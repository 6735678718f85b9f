"""Column-in, Column-out expressions. Nothing here starts a Spark job."""
