"""DuckDB SQL for the comparison run: one statement per registered query."""
