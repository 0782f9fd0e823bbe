"""Every operator on the shared test tables, each with the same result in DuckDB SQL where SQL can say it."""
