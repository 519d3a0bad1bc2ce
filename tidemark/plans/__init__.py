"""Scale helpers and the registered stand-in queries."""
