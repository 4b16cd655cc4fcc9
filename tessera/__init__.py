"""tessera: evidence analytics and corpus preparation as composable PySpark jobs."""
