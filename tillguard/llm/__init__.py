"""Training-data operators: sharding, toxicity, packing, secret scans,
fingerprints, quality rules, HTML extraction, similarity join, byte-level BPE,
WARC archives, embedding whitening, top-k products and lexical search.
Nothing outside this subpackage imports it."""
