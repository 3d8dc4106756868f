"""Domain and relational operators, each a ``DataFrame -> DataFrame`` function."""
