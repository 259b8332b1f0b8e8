"""Table operators: DataFrame in, DataFrame out, nothing runs before an action
unless the docstring says so."""
