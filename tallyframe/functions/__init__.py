"""Column -> Column helpers. All of them stay inside whole-stage codegen; none is a Python UDF."""
