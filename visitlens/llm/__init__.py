"""Training-data operators: packing, secret scans, mixing, URL filters,
near-duplicates, language-model scores, fingerprints, licences, language
identification and quality rules. Nothing outside this package imports it."""
