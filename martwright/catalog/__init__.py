"""The marts on the benchmark tables: inputs, registered queries and their reference SQL."""
