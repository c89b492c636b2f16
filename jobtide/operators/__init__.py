"""DataFrame-in, DataFrame-out relational operators."""
