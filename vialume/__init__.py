"""Road-traffic analytics as Spark DataFrame, streaming and MLlib operators."""
