"""The three batch jobs: prepare a clean table, train and compare, rate and report."""
