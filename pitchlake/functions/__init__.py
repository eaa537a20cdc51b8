"""Column expressions. Every function takes and returns a ``Column`` and stays in generated code."""
