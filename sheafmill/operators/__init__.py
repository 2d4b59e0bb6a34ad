"""DataFrame operators: splits, features, mining, clustering, scoring."""
