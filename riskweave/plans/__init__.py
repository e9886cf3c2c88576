"""The five stages: profile, clean and split, select, train, evaluate."""
