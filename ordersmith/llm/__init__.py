"""Training-data operators: quality, token counts, dedup, URL rules, decontamination,
packing, language, toxicity, near-dedup and WARC archives.

Nothing else in the library imports this subpackage.
"""
