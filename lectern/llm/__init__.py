"""Training-data operators: dedup, filtering, decontamination, tokenising."""
