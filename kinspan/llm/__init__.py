"""Training-data operators: WARC, de-duplication, decontamination, quality, language, mixing, sharding."""
