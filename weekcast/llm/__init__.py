"""Training-data operators: mixing, deduplication, token counts, quality, PII, LM scoring,
token files and decontamination.  One module per operator; ``queries`` registers them."""
