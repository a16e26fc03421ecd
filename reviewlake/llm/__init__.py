"""Training-data operators: search, license scans, packing, mixing, chat formatting,
toxicity, language-model scoring, token rollups and near-duplicate detection.

Nothing else in the library imports this subpackage.
"""
