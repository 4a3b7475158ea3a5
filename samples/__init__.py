"""Fleet inputs derived from the generic test tables, in Spark and in DuckDB SQL."""
