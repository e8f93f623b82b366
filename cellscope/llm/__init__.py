"""Training-data pipeline operators (line dedup, tokenizers, classifiers, search, mixing)."""
