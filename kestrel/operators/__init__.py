"""DataFrame operators grouped by concern: profile, clean, features, balance,
evaluate, models and graph."""
