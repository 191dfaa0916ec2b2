"""Training-data operators: licence scans, quality, deduplication, toxicity, chat formatting, packing,
token files, decontamination and language id. Nothing else in the package imports this subpackage."""
