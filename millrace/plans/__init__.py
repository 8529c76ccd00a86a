"""What a user declares: streams, tables, replicas, and the SQL made of them."""
