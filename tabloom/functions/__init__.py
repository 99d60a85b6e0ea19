"""Column expressions. All are native, so they stay inside whole-stage code generation."""
