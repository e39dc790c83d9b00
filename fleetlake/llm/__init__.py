"""Training-data operators (language id, dedup, fingerprints, sharding, toxicity,
decontamination, LM scoring, tokenisation).  Nothing else in the library imports this."""
