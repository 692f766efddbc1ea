"""DataFrame operators: joins, novelty, ranking, trends, corpus statistics, threads, translation."""
