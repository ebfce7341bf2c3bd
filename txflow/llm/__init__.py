"""Training-data operators: URL rules, packing, near-duplicates, search, PII, BPE, licenses, language, secrets."""
