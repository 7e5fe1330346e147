"""Call-record reporting on Spark."""
