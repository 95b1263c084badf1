"""Table-to-table operators: DataFrame in, DataFrame out, no actions unless stated."""
