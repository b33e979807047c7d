"""DataFrame operators: hygiene, stylometry, lexicons, corpus statistics, feature preparation, models, evaluation."""
