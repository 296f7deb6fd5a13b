"""Pure ``Column`` builders: no action, no join, no UDF."""
