"""Training-data operators: extraction, fixity, dedup, scans, tokens, decontamination."""
