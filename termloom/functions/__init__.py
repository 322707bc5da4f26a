"""Column expressions: no DataFrame, no action, all inside the JVM."""
