"""Column expressions: text, codes, URLs and arrays. All JVM-side built-ins."""
