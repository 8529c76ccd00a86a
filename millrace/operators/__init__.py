"""DataFrame operators: typing, sizing, keyed upsert, rejection, replication."""
