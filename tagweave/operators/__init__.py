"""DataFrame operators: matching, aggregation, features, clustering, classification."""
