"""Column expressions and in-task numeric kernels."""
