"""Training-data operators: PII, packing, WARC, decontamination, toxicity, language, dedup, joins, media, LM scores."""
