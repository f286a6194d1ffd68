"""Layer composition: full build and incremental steps, pure and stored."""
