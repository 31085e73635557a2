"""Column -> Column helpers; all stay inside the JVM."""
