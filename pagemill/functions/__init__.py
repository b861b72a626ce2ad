"""Column expressions. Everything here is Column -> Column and runs in the JVM."""
