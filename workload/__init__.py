"""The registered queries: their inputs, their senders, and the SQL they are checked against."""
