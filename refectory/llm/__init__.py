"""Training-data operators: toxicity, de-duplication, packing, mixing, language-model scoring, vector codes, resampling, secret scans."""
