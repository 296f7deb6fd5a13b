"""Tables and files in and out, staging, and hash-driven table synthesis."""
