"""Training-data operators: ten distributed text-corpus operators and their registered queries."""
