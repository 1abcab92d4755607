"""Column functions: labels, numbers, dates and keyword arrays. All stay in the JVM."""
