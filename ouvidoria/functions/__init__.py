"""Column functions: ``Column -> Column``, all inside the JVM."""
