"""Social-review tables derived from the test tables, and the queries run on them."""
