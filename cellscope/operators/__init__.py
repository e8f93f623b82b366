"""DataFrame operators: cleaning, profiles, aggregations, quantiles, correlations, distributions, ranking, sampling, scaling, weight search, map data."""
