"""Training-data operators: toxicity, decontamination, URL lists, fingerprints,
n-gram Jaccard groups, chat formatting, source mixing, token counts, license
scans and language ID. Nothing else in the library imports this package."""
