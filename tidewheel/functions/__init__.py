"""Column functions; all of them stay on the JVM."""
