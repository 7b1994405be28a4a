"""Column expressions: everything here stays inside the JVM (no Python UDFs)."""
