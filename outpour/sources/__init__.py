"""Tables and files that a delivery reads and writes, and the session they live in."""
