"""Training-data operators: de-duplication, mixing, quality, fingerprints,
decontamination, token counts, WARC revisits, similarity join, secret scans and
token output. Nothing outside this package imports it."""
