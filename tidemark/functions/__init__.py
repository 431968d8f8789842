"""Column expressions: parsing, missing values, rounding and text. All JVM-side."""
