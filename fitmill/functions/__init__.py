"""Column expressions: text in, column out, no shuffle and no Python at run time."""
