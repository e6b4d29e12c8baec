"""Data jobs: marts (M1-M8), ML features (M9-M11), dashboard queries (D1-D9)."""
