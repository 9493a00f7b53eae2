"""Catalyst expressions over text cells; all of them stay inside the JVM."""
